"""Tokenisation as column expressions: text in, fixed-length id arrays out.

Rules: a vocabulary letter or literal is one token, white space only separates,
and a run of anything else is one unknown token.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import ESM2, Vocabulary

# The Unicode white-space code points, below and above 256.
LATIN_SPACE = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0)
OTHER_SPACE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _codes(chars) -> str:
    """Characters or code points as regex escapes, for use inside or outside a class."""
    return "".join(rf"\x{{{c if isinstance(c, int) else ord(c):x}}}" for c in chars)


def letter_class(vocab: Vocabulary = ESM2) -> str:
    return _codes(vocab.letters)


def symbol_pattern(vocab: Vocabulary = ESM2) -> str:
    """Regex for one token.

    Characters below 256 are listed one by one, not as ranges or complements, because
    the engine tests such a class with one bit; that is three times as fast on prose.
    Runs are possessive, so they need no stack however long they are.
    """
    literals = "|".join(_codes(s) for s in vocab.literals)
    openers = {s[0] for s in vocab.literals}
    taken = {*map(ord, vocab.letters), *map(ord, openers), *LATIN_SPACE}
    plain = _codes(c for c in range(256) if c not in taken)
    foreign = _codes(c for c in sorted(taken) if c > 255)
    run = rf"[{plain}]++|[^\x00-\xff{OTHER_SPACE}{foreign}]++"
    letter = f"[{letter_class(vocab)}]"
    if not literals:
        return f"(?:{letter}|(?:{run})++)"
    return f"(?:{letter}|(?:{run}|(?!{literals})[{_codes(sorted(openers))}])++|{literals})"


def symbols(text: Column, vocab: Vocabulary = ESM2) -> Column:
    """All tokens of the text, as strings."""
    return F.regexp_extract_all(text, F.lit(symbol_pattern(vocab)), F.lit(0))


def _letter_id(symbol: Column, vocab: Vocabulary) -> Column:
    """Id of a letter, from a table by code point; NULL for any other symbol."""
    size = max(map(ord, vocab.letters)) + 1
    ids = [str(vocab.ids.get(chr(c), "null")) for c in range(size)]
    return F.get(F.expr(f"cast(array({', '.join(ids)}) as array<int>)"), F.ascii(symbol))


def symbol_id(symbol: Column, vocab: Vocabulary = ESM2) -> Column:
    """Id of one token string; whatever is not in the vocabulary is unknown."""
    other = F.lit(vocab.unk_id)
    if vocab.literals:
        table = F.create_map(*[F.lit(v) for s in vocab.literals for v in (s, vocab.ids[s])])
        other = F.when(symbol.isin(vocab.literals), F.element_at(table, symbol)).otherwise(other)
    return F.coalesce(_letter_id(symbol, vocab), other)


def symbol_ids(tokens: Column, vocab: Vocabulary = ESM2) -> Column:
    return F.transform(tokens, lambda t: symbol_id(t, vocab))


def letter_ids(text: Column, vocab: Vocabulary = ESM2) -> Column:
    """Ids of a text that consists of vocabulary letters only."""
    letters = F.transform(F.split(text, ""), lambda c: _letter_id(c, vocab))
    return F.when(text == "", F.array().cast("array<int>")).otherwise(letters)


def leading_ids(text: Column, n: int, vocab: Vocabulary = ESM2) -> Column:
    """Ids of the first ``n`` tokens of the whole text, equal to slicing all of them.

    If the first ``n`` characters are letters they are the first ``n`` tokens,
    whatever follows. Otherwise one anchored match finds where token ``n`` ends,
    so the rest of a long text is never turned into an array.
    """
    text = F.coalesce(text, F.lit(""))
    head = F.substring(text, 1, n)
    only_letters = head.rlike(rf"^[{letter_class(vocab)}]*+\z")
    space = f"[{_codes(LATIN_SPACE)}{OTHER_SPACE}]*+"
    upto = f"^(?:{space}{symbol_pattern(vocab)}){{0,{n}}}+"
    mixed = symbols(F.regexp_extract(text, upto, 0), vocab)
    return F.when(only_letters, letter_ids(head, vocab)).otherwise(symbol_ids(mixed, vocab))


def framed(ids: Column, max_length: int, vocab: Vocabulary = ESM2) -> Column:
    """Start token, at most ``max_length - 2`` ids, end token."""
    body = F.slice(ids, 1, max_length - 2)
    return F.concat(F.array(F.lit(vocab.cls_id)), body, F.array(F.lit(vocab.eos_id)))


def padded(ids: Column, max_length: int, vocab: Vocabulary = ESM2) -> Column:
    fill = F.array_repeat(F.lit(vocab.pad_id), F.lit(max_length) - F.size(ids))
    return F.concat(ids, fill)


def attention_mask(real: Column, max_length: int) -> Column:
    """``real`` ones followed by zeros, ``max_length`` in all: a window on a constant."""
    ones_then_zeros = F.concat(
        F.array_repeat(F.lit(1), max_length), F.array_repeat(F.lit(0), max_length)
    )
    return F.slice(ones_then_zeros, F.lit(max_length + 1) - real, max_length)


def mask_of_length(real: Column, length: Column) -> Column:
    """``real`` ones followed by zeros, as long as the row's ids."""
    return F.concat(F.array_repeat(F.lit(1), real), F.array_repeat(F.lit(0), length - real))


def real_length(mask: Column) -> Column:
    """Tokens in front of the padding: where the first zero of a mask is."""
    first_pad = F.array_position(mask, 0).cast("int")
    return F.when(first_pad == 0, F.size(mask)).otherwise(first_pad - 1)
