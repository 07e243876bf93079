"""Symbol tables for character-level sequence tokenisers."""

from dataclasses import dataclass
from functools import cached_property

# The published ESM-2 alphabet, listed in id order (0..32).
ESM2_SYMBOLS = (
    "<cls> <pad> <eos> <unk> "
    "L A G V S E R T I D P K Q N F Y M H W C X B U Z O . - "
    "<null_1> <mask>"
).split()


@dataclass(frozen=True)
class Vocabulary:
    """Symbols in id order, plus the names of the special ones.

    A one-character symbol is always a token of its own; a longer symbol is a
    literal such as ``<mask>`` that is recognised inside the text.
    """

    symbols: tuple[str, ...]
    cls: str = "<cls>"
    pad: str = "<pad>"
    eos: str = "<eos>"
    unk: str = "<unk>"
    mask: str = "<mask>"

    @cached_property
    def ids(self) -> dict[str, int]:
        return {symbol: i for i, symbol in enumerate(self.symbols)}

    @cached_property
    def letters(self) -> str:
        return "".join(s for s in self.symbols if len(s) == 1)

    @cached_property
    def literals(self) -> list[str]:
        return sorted((s for s in self.symbols if len(s) > 1), key=lambda s: (-len(s), s))

    @property
    def cls_id(self) -> int:
        return self.ids[self.cls]

    @property
    def pad_id(self) -> int:
        return self.ids[self.pad]

    @property
    def eos_id(self) -> int:
        return self.ids[self.eos]

    @property
    def unk_id(self) -> int:
        return self.ids[self.unk]

    @property
    def mask_id(self) -> int:
        return self.ids[self.mask]

    @property
    def special_ids(self) -> list[int]:
        """Ids that masking must leave alone."""
        return sorted({self.cls_id, self.pad_id, self.eos_id, self.unk_id, self.mask_id})


ESM2 = Vocabulary(tuple(ESM2_SYMBOLS))
