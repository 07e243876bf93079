"""Replaces personal data by surrogates of the same type, gender, script and format.

Found are e-mail addresses, phone numbers, payment card and account numbers, social security
numbers, IPv4 and IPv6 addresses, secrets (tokens, keys, passwords) and names of persons. An entity is a
kind and a value in one spelling, so that all mentions of it, in whatever format and document,
get one surrogate. A surrogate is drawn from a keyed hash of the entity and an attempt number;
the candidates of all entities meet in Spark, and one that another entity also drew, or that
stands in the corpus itself, goes to its next attempt, until all are distinct. Documents
without any mention are not moved.

Names are entities word by word: a surname keeps its surrogate with and without the first
name. The gender of a first name comes from its title or from a list. Where a name was found
once, all other places of its words in the text, capitalised or in capitals, are mentions too.

Defined results: a null text stays null, an empty one empty. Repeated rows are treated alike.
An empty table gives no rows. Other columns are ignored by ``pseudonymise`` and kept by
``without_personal_data``.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import stored
from .substrings import text_key
from .tasks import map_arrow

# Common first names by script and gender, and titles by gender.
FIRST_NAMES = {
    ("latin", "f"): "Anna Maria Julia Laura Sarah Emma Sophie Claire Elena Lucia Carmen Ingrid Helga Marie Camille "
                    "Alice Emily Hannah Olivia Isabel",
    ("latin", "m"): "John James Peter Paul Thomas Michael David Robert Hans Karl Pierre Jean Louis Carlos Juan Miguel "
                    "Pedro Henry William George",
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Ирина Татьяна Светлана",
    ("cyrillic", "m"): "Иван Сергей Алексей Дмитрий Николай Павел Михаил Андрей",
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία",
    ("greek", "m"): "Γιώργος Νίκος Κώστας Δημήτρης",
}
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Mademoiselle Señora Sra Señorita Doña Госпожа Κυρία",
    "m": "Mr Herr Monsieur Señor Sr Don Господин Κύριος",
    "u": "Dr Prof Professor",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ka ke ko la le lo ma me mi mo na ne no pa pe ra re ri ro sa se so ta te to va ve wi zo",
    "cyrillic": "ба ве го да же за ки ла ме но па ри со ту фи хо",
    "greek": "βα γε δο ζη θα κι λε μο νι πα ρο σι τε φα",
}
LAST_OF_SURNAME = {"latin": "n r s l", "cyrillic": "в н к", "greek": "ς"}
LAST_OF_FIRST = {
    ("latin", "f"): "a", ("latin", "m"): "o", ("latin", "u"): "e", ("cyrillic", "f"): "а", ("cyrillic", "m"): "н",
    ("cyrillic", "u"): "я", ("greek", "f"): "α", ("greek", "m"): "ς", ("greek", "u"): "ω",
}

_GENDER_OF = {name: gender for (_, gender), names in FIRST_NAMES.items() for name in names.split()}
_TITLE_OF = {title: gender for gender, titles in TITLES.items() for title in titles.split()}
_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)?"
_TITLED = re.compile(rf"(?<!\w)({'|'.join(_TITLE_OF)})\.?[ \t]+({_NAME})(?:[ \t]+({_NAME}))?")
_NAMED = re.compile(rf"(?<!\w)({'|'.join(_GENDER_OF)})[ \t]+({_NAME})")
_WHOLE_NAME = re.compile(rf"(?<!\w){_NAME}(?!\w)")
_LETTERS = re.compile(r"[^\W\d_]+")

# Hints begin with a set of letters, which is quick to look for; a title or name must follow.
_TITLE = re.compile(rf"(?:{'|'.join(_TITLE_OF)})(?!\w)")
_FIRST_NAME = re.compile(rf"(?:{'|'.join(_GENDER_OF)})[ \t]")
_ACCOUNT = re.compile(r"[A-Z]{2}\d{2}")

_EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)+")
_SECRET = re.compile(
    r"(?i)(?<![a-z])(?:token|secret|password|passwd|api[ _-]?key|access[ _-]?key|auth[ _-]?key)\s{0,3}[=:]\s{0,3}([\"']?)([^\s\"']{6,})(?:\1)"
)
_KEY_ID = re.compile(r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Where numbers can be; a run holds one or several.
_DIGITS = re.compile(r"\d[\d+() .-]{5,}")
_NUMBER = re.compile(
    r"(?<![\w.])(?:"
    rf"(?P<ip>(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d))"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\w))"
    r"|(?P<phone>(?:"
    # Eight digits or more in groups of any size, or fewer in groups of two to four.
    r"\+(?=\d(?:[ .()-]{0,3}\d){7})\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{1,4}){1,5}"
    r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}"
    r"|(?:(?<!\d-)1[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|(?:(?<!\d-)1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}"
    # National numbers with their leading zero, but no dates.
    r"|\(0\d{1,4}\)[ .-]?\d{2,8}(?:[ .-]?\d{2,8}){0,3}"
    r"|(?<!\d-)(?!\d\d(?:\.\d\d\.|-\d\d-)\d{4}(?!\d))(?=0[1-9](?:[ .-]?\d){6})0[1-9]\d{0,3}(?:[ .-]?\d{2,8}){1,4}"
    r")(?!\w))"
    r")"
)
# The country code of North America without its plus.
_TRUNK = re.compile(r"1(?:[ .-]\d{3}[ .-]|[ .-]?\()")
_CARD = re.compile(r"(?<![\w.])(?<!\d-)\d{4}(?:[ -]?\d){9,}")
_GROUPS = re.compile(r"\d+")
# A quick hint, and what can be an IPv6 address.
_COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,8}[0-9A-Fa-f]{0,4}(?!\w|:\w|\.\d)")


@dataclass(frozen=True)
class Mention:
    start: int
    end: int
    kind: str
    value: str


def _script(word: str) -> str:
    first = ord(word[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


def _capital(word: str | None) -> bool:
    return bool(word) and word[0].isupper() and len(word) > 1


def _name(m: re.Match, group: int, kind: str) -> Mention:
    """A name without the ending of the genitive."""
    word = re.sub("['’][sS]$", "", m[group])
    return Mention(m.start(group), m.start(group) + len(word), kind, word.casefold())


def _names(text: str) -> Iterator[Mention]:
    if _TITLE.search(text):
        for m in _TITLED.finditer(text):
            gender, one, two = _TITLE_OF[m[1]], m[2], m[3]
            if not _capital(one):
                continue
            if _capital(two):
                gender = gender if gender != "u" else _GENDER_OF.get(one, "u")
                yield _name(m, 2, f"first_{gender}_{_script(one)}")
                yield _name(m, 3, f"surname_{_script(two)}")
            else:
                yield _name(m, 2, f"surname_{_script(one)}")
    if _FIRST_NAME.search(text):
        for m in _NAMED.finditer(text):
            if _capital(m[2]):
                yield Mention(*m.span(1), f"first_{_GENDER_OF[m[1]]}_{_script(m[1])}", m[1].casefold())
                yield _name(m, 2, f"surname_{_script(m[2])}")


def _numbers(text: str) -> Iterator[Mention]:
    end = 0
    for run in _DIGITS.finditer(text):
        # A number begins with at most a plus and a bracket before its first digit.
        for m in _NUMBER.finditer(text, max(run.start() - 2, end), min(run.end() + 1, len(text))):
            end = m.end()
            yield _number(m)
        if run.end() - run.start() >= 13:
            for m in _CARD.finditer(text, run.start(), run.end()):
                yield from _card(text, m)


def _card(text: str, m: re.Match) -> Iterator[Mention]:
    """The longest row of whole groups with 13 to 19 digits and the right check digit."""
    for group in reversed([*_GROUPS.finditer(text, *m.span())]):
        digits = re.sub(r"\D", "", text[m.start() : group.end()])
        if 13 <= len(digits) <= 19 and luhn(digits) == 0 and not re.match(r"\w", text[group.end() : group.end() + 1]):
            yield Mention(m.start(), group.end(), "card", digits)
            return


def _ipv6(text: str) -> Iterator[Mention]:
    for m in _IPV6.finditer(text):
        # A colon may follow the address.
        for found in (m[0], m[0].removesuffix(":")):
            try:
                value = ipaddress.IPv6Address(found)
            except ValueError:
                continue
            # Names with two colons between letters are no addresses; the loopback tells nothing.
            if int(value) > 1 and (re.search(r"\d", found) or len(re.findall(r"\w+", found)) > 2):
                yield Mention(m.start(), m.start() + len(found), "ip6", ":".join(re.findall("....", f"{int(value):032x}")))
            break


def _number(m: re.Match) -> Mention:
    kind, value = m.lastgroup, m[0]
    if kind != "ip":
        value = re.sub(r"[^\d+]", "", value)
    if kind == "phone":
        code = re.match(r"\+\d{1,3}(?=[ .(-])", m[0])
        value = f"{code[0] if code else ''}|{value[len(code[0]) if code else 0:]}"
        if _TRUNK.match(m[0]):
            value = f"+1|{value[2:]}"
    return Mention(*m.span(), kind, value)


def mentions(text: str) -> list[Mention]:
    """All mentions of a text in order; where two overlap, the earlier and then longer one."""
    found: list[Mention] = []
    if "@" in text:
        found += [Mention(*m.span(), "email", m[0].lower()) for m in _EMAIL.finditer(text)]
    if "=" in text or ":" in text:
        found += [Mention(*m.span(2), "secret", m[2]) for m in _SECRET.finditer(text)]
    if "AKIA" in text:
        found += [Mention(*m.span(), "secret", m[0]) for m in _KEY_ID.finditer(text)]
    found += _numbers(text)
    if _COLONS.search(text):
        found += _ipv6(text)
    if _ACCOUNT.search(text):
        found += [Mention(*m.span(), "iban", m[0].replace(" ", "")) for m in _IBAN.finditer(text) if _iban_rest(m[0].replace(" ", "")) == 1]
    found += _names(text)
    found.sort(key=lambda m: (m.start, -m.end))
    out: list[Mention] = []
    for m in found:
        if not out or m.start >= out[-1].end:
            out.append(m)
    return out


def all_mentions(text: str) -> list[Mention]:
    """``mentions``, and all other places of the names among them; no further entities."""
    found = mentions(text)
    names: dict[str, Mention] = {}
    for m in found:
        if m.kind.startswith(("first_", "surname_")):
            names.setdefault(m.value, m)
    if not names:
        return found
    again = [Mention(start, end, names[value].kind, value) for start, end, value in _named_again(text, names)]
    out: list[Mention] = []
    at, n = 0, len(found)
    for m in again:
        while at < n and found[at].end <= m.start:
            out.append(found[at])
            at += 1
        if at == n or m.end <= found[at].start:
            out.append(m)
    return out + found[at:]


def _named_again(text: str, names: dict[str, Mention]) -> Iterator[tuple[int, int, str]]:
    for m in _WHOLE_NAME.finditer(text):
        word = m[0]
        if (value := word.casefold()) in names and word[0].isupper():
            yield *m.span(), value
        elif not word.isalpha():
            for part in _LETTERS.finditer(text, *m.span()):
                if (value := part[0].casefold()) in names and part[0][0].isupper():
                    yield *part.span(), value


class Draw:
    """Numbers drawn from a keyed hash."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.seed, self.count, self.left = (key, "\x1f".join(parts).encode()), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hashlib.blake2b(self.seed[1] + b"\x1f%d" % self.count, key=self.seed[0][:64]).digest()
            self.count += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n

    def pick(self, options: str):
        return options[self.below(len(options))]


def luhn(digits: str) -> int:
    """0 if the check digit is right."""
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _same_classes(value: str, draw: Draw) -> str:
    """Letters for letters, digits for digits, hexadecimal where all of it is."""
    if value.isdecimal() or len(value) < 8:
        pass
    elif re.fullmatch(r"[0-9a-f]+", value):
        return "".join(draw.pick("0123456789abcdef") for _ in value)
    elif re.fullmatch(r"[0-9A-F]+", value):
        return "".join(draw.pick("0123456789ABCDEF") for _ in value)
    out = []
    for c in value:
        if c.isdecimal():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            script = _script(c) if not c.isascii() else "latin"
            letters = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}[script]
            out.append(draw.pick(letters).upper() if c.isupper() else draw.pick(letters))
        else:
            out.append(c)
    return "".join(out)


def _ip(value: str, draw: Draw) -> str:
    octets = [int(o) for o in value.split(".")]
    keep = 1 if octets[0] in (0, 10, 127) or octets[0] >= 224 else 2 if octets[:2] == [192, 168] or (octets[0] == 172 and 16 <= octets[1] < 32) else 0
    drawn = octets[:keep] + [draw.below(256) for _ in range(4 - keep)]
    if keep == 0:
        # A public address stays one.
        while drawn[0] in (0, 10, 127, 172, 192) or drawn[0] >= 224:
            drawn[0] = draw.below(224)
    return ".".join(map(str, drawn))


def _ip6(value: str, attempt: int, draw: Draw) -> str:
    """Link-local, local and multicast addresses stay such; groups keep their lengths at first."""
    groups = [int(g, 16) for g in value.split(":")]
    out = []
    for i, g in enumerate(groups):
        low, high = (1, 0xFFFF) if attempt >= 4 else (16 ** (len(f"{g:x}") - 1), 16 ** len(f"{g:x}") - 1)
        drawn = low + draw.below(high - low + 1)
        if i == 0 and g:
            # The first group says what kind of address it is.
            drawn = g if g >> 8 >= 0xFC else 0x2000 + draw.below(0x1000)
        out.append(drawn if g or (attempt >= 16 and i) else 0)
    return ":".join(f"{g:04x}" for g in out)


def _as_ip6(mention: str, surrogate: str) -> str:
    left, two, right = mention.partition("::")
    left, right = ([g for g in x.split(":") if g] for x in (left, right))
    groups = surrogate.split(":")
    if two and any(int(g, 16) for g in groups[len(left) : 8 - len(right)]):
        return surrogate
    write = lambda old, new: f"{int(new, 16):0{len(old)}x}" if len(old) > 1 and old[0] == "0" else f"{int(new, 16):x}"
    parts = [":".join(write(o, n) for o, n in zip(old, new)) for old, new in ((left, groups), (right, groups[8 - len(right) :]))]
    out = two.join(parts) if two else parts[0]
    return out.upper() if re.search("[A-F]", mention) else out


def candidate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """The surrogate of an entity at an attempt; later attempts have more to choose from."""
    draw = Draw(key, kind, value, str(attempt))
    longer = attempt // 4
    if kind == "email":
        local, domain = value.split("@", 1)
        labels = domain.split(".")
        # Addresses of one domain keep a common one.
        named = [_same_classes(x, Draw(key, "domain", domain, str(i))) for i, x in enumerate(labels[:-1])]
        more = "".join(str(draw.below(10)) for _ in range(longer))
        return f"{_same_classes(local, draw)}{more}@{'.'.join([*named, labels[-1]])}"
    if kind == "ip":
        return _ip(value, draw)
    if kind == "ip6":
        return _ip6(value, attempt, draw)
    if kind == "phone":
        code, rest = value.split("|")
        drawn = "".join(str(draw.below(10)) for _ in rest)
        if not code and rest[0] == "0":
            # A national number keeps its leading zero.
            drawn = f"0{1 + draw.below(9)}{drawn[2:]}" if rest[1] != "0" else f"0{drawn[1:]}"
        return f"{code}|{drawn}"
    if kind in ("card", "ssn"):
        digits = value[0] + "".join(str(draw.below(10)) for _ in value[1:])
        if kind == "card" and luhn(value) == 0:
            digits = next(d for d in (digits[:-1] + c for c in "0123456789") if luhn(d) == 0)
        return digits
    if kind == "iban":
        rest = _same_classes(value[4:], draw)
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + rest):02d}{rest}"
    if kind.startswith("first_"):
        _, gender, script = kind.split("_")
        names = " ".join(FIRST_NAMES.get((script, g), "") for g in ("fm" if gender == "u" else gender)).split()
        if attempt < 3:
            return names[draw.below(len(names))].casefold()
        return _word(script, 2 + longer, draw) + LAST_OF_FIRST[script, gender]
    if kind.startswith("surname_"):
        script = kind.split("_")[1]
        return _word(script, 2 + len(value) // 6 + longer, draw) + draw.pick(LAST_OF_SURNAME[script].split())
    return _same_classes(value, draw) + "".join(str(draw.below(10)) for _ in range(longer if len(value) < 8 else 0))


def _word(script: str, syllables: int, draw: Draw) -> str:
    return "".join(draw.pick(SYLLABLES[script].split()) for _ in range(syllables))


def rendered(mention: str, kind: str, surrogate: str) -> str:
    """The surrogate in the format of a mention."""
    if kind in ("phone", "card", "ssn"):
        fresh = iter(re.sub(r"\D", "", surrogate))
        return re.sub(r"\d", lambda _: next(fresh), mention)
    if kind == "ip6":
        return _as_ip6(mention, surrogate)
    if kind == "iban":
        fresh = iter(surrogate)
        return re.sub(r"[^ ]", lambda _: next(fresh), mention)
    if kind == "email":
        return surrogate.upper() if mention.isupper() else surrogate
    if kind.startswith(("first_", "surname_")):
        return surrogate.upper() if mention.isupper() else surrogate.capitalize()
    return surrogate


def found_in(docs: DataFrame) -> DataFrame:
    """``k, tag, kind, value``: the entities of each distinct text, once per text."""

    def each(batch):
        k, tag = batch.column("k").to_pylist(), batch.column("tag").to_pylist()
        rows = [
            (k[i], tag[i], *entity)
            for i, text in enumerate(batch.column("text"))
            for entity in sorted({(m.kind, m.value) for m in mentions(text.as_py() or "")})
        ]
        if rows:
            yield dict(zip(("k", "tag", "kind", "value"), zip(*rows)))

    texts = docs.select(*text_key(), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, "k bigint, tag int, kind string, value string", each).distinct()


def assigned(entities: DataFrame, key: bytes, attempts: int = 64) -> DataFrame:
    """``kind, value, surrogate`` for distinct ``kind, value``; no surrogate twice, and none
    that is a value itself.

    Of the entities that draw the same surrogate the one with the least value keeps it.
    """
    spark = entities.sparkSession

    def draw(attempt: int):
        @F.arrow_udf("string")
        def drawn(kind: pa.Array, value: pa.Array) -> pa.Array:
            return pa.array([candidate(k.as_py(), v.as_py(), attempt, key) for k, v in zip(kind, value)], pa.string())

        return drawn(F.col("kind"), F.col("value"))

    taken = entities.select("kind", F.col("value").alias("surrogate"))
    pending, done = entities, []
    for attempt in range(attempts):
        drawn = stored(spark, pending.select("kind", "value", draw(attempt).alias("surrogate")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        won = stored(spark, first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "value", "surrogate"), "surrogates")
        done.append(won)
        taken = taken.unionAll(won.select("kind", "surrogate"))
        pending = stored(spark, drawn.select("kind", "value").join(won.select("kind", "value"), ["kind", "value"], "left_anti"), "pending")
        if pending.isEmpty():
            break
    else:
        raise RuntimeError(f"{attempts} attempts left entities without a surrogate")
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def _has_mentions(column: pa.Array) -> pa.Array:
    return pa.array([bool(mentions(text.as_py() or "")) for text in column], pa.bool_())


def _replaced(column: pa.Array, kinds: pa.Array, values: pa.Array, surrogates: pa.Array) -> pa.Array:
    out = []
    for text, *known in zip(column, kinds, values, surrogates):
        text = text.as_py()
        names = {(k, v): s for k, v, s in zip(*(x.as_py() for x in known))}
        parts, at = [], 0
        for m in all_mentions(text):
            parts += [text[at : m.start], rendered(text[m.start : m.end], m.kind, names[m.kind, m.value])]
            at = m.end
        out.append("".join([*parts, text[at:]]))
    return pa.array(out, pa.string())


def without_personal_data(docs: DataFrame, key: bytes, n_entities: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; all rows and columns stay.

    ``n_entities`` names a further column for the number of distinct entities of a row.
    """
    spark = docs.sparkSession
    found = stored(spark, found_in(docs), "entities")
    names = stored(spark, assigned(stored(spark, found.select("kind", "value").distinct(), "distinct-entities"), key), "names")
    per_text = stored(
        spark,
        found.join(names, ["kind", "value"]).groupBy("k", "tag")
        .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("names")),
        "names-of-texts",
    )
    text: Column = F.col("text").cast("string")
    flag = F.arrow_udf(_has_mentions, "boolean")(text)
    k, tag = text_key()
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    mine = docs.where(flag).select(whole, k.alias("_k"), tag.alias("_tag"))
    other = per_text.select(F.col("k").alias("_k"), F.col("tag").alias("_tag"), F.col("names").alias("_names"))
    # Merged, also where few texts have mentions: a broadcast join would put the flag and the
    # replacement into one stage, and each task would hold two Python processes.
    met = mine.join(other.hint("merge"), ["_k", "_tag"])
    new = F.arrow_udf(_replaced, "string")(F.col("row.text").cast("string"), F.col("_names.kind"), F.col("_names.value"), F.col("_names.surrogate"))
    count = [] if n_entities is None else [F.size("_names").cast("bigint").alias(n_entities)]
    none = [] if n_entities is None else [F.lit(0).cast("bigint").alias(n_entities)]
    changed = met.select(*[(new if name == "text" else F.col(f"row.`{name}`")).alias(name) for name in docs.columns], *count)
    return changed.unionAll(docs.where(~flag).select(*[F.col(f"`{name}`") for name in docs.columns], *none))


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id, text, n_entities`` of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return without_personal_data(rows, key, "n_entities")
