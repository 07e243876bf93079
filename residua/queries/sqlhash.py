"""xxHash64 in SQL, written from its specification, to check the seeded operators.

A value runs through the steps inside a list, because a lambda names it and a step may
then use it twice. All arithmetic is on 128-bit unsigned integers modulo 2**64.
"""

# The five primes of the hash.
P1 = 0x9E3779B185EBCA87
P2 = 0xC2B2AE3D27D4EB4F
P3 = 0x165667B19E3779F9
P4 = 0x85EBCA77C2B2AE63
P5 = 0x27D4EB2F165667C5

START = 42


def _u(n: int) -> str:
    return f"{n}::UHUGEINT"


M = _u(2**64)


def _mul(a: str, prime: int) -> str:
    return f"(({a}) * {_u(prime)} % {M})"


def _add(a: str, n: int) -> str:
    return f"((({a}) + {_u(n)}) % {M})"


def _rotl(x: str, r: int) -> str:
    return f"({x} * {_u(2**r)} % {M} + {x} // {_u(2 ** (64 - r))})"


def _steps(values: str, *steps: str) -> str:
    for step in steps:
        values = f"list_transform({values}, lambda x: {step})"
    return values


AVALANCHE = (
    _mul(f"xor(x, x // {_u(2**33)})", P2),
    _mul(f"xor(x, x // {_u(2**29)})", P3),
    f"xor(x, x // {_u(2**32)})",
)


def _long_step(state: str, value: str) -> str:
    """State list after a 64-bit value; ``value`` is a column or literal."""
    word = _mul(_rotl(_mul(f"({value})::UHUGEINT", P2), 31), P1)
    return _steps(
        state, f"xor({_add('x', P5 + 8)}, {word})",
        _add(_mul(_rotl("x", 27), P1), P4), *AVALANCHE,
    )


def hash_longs(*values: str) -> str:
    """Unsigned hash of non-negative or unsigned 64-bit values."""
    state = f"[{_u(START)}]"
    for value in values:
        state = _long_step(state, value)
    return f"({state})[1]"


def position_hashes(state: str, n: int) -> str:
    """List of the hashes of 32-bit positions 0 … n-1, continuing from ``state``."""
    return _steps(
        f"list_transform(range({n}), lambda i: xor({_add(state, P5 + 4)}, "
        f"{_mul('i::UHUGEINT', P1)}))",
        _add(_mul(_rotl("x", 23), P2), P3), *AVALANCHE,
    )


def seeded_hash_sql(seed: int, value: str) -> str:
    """The package's 60-bit hash of a seed and an integer."""
    return f"({hash_longs(str(seed), value)} // 16)::BIGINT"
