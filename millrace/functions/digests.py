"""Order-free digests of a bag of values, made of aggregates Spark combines map-side."""

from __future__ import annotations

_CHUNK = (1 << 21) - 1


def bag_digest(expression: str) -> str:
    """One struct aggregate that two equal bags of values share.

    XOR alone cancels pairs of equal values, so the exact sum of the 64-bit hashes
    goes with it. The sum is kept as three sums of 21, 21 and 22 bits: each stays
    in a long up to 2**41 rows and none needs decimal arithmetic.
    """
    h = f"xxhash64({expression})"
    return (
        f"struct(count(1) AS n_rows, bit_xor({h}) AS xor, sum({h} & {_CHUNK}) AS sum_low, "
        f"sum(shiftrightunsigned({h}, 21) & {_CHUNK}) AS sum_mid, "
        f"sum(shiftrightunsigned({h}, 42)) AS sum_high)"
    )


def digest_as_double(digest: str) -> str:
    """The digest folded to 53 bits, which a double holds exactly; for display."""
    return f"double(shiftrightunsigned(xxhash64({digest}), 11))"
