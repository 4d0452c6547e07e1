"""Text read as one big integer, two linear hash families, and partition functions.

A text stands for the integer formed by its UTF-8 bytes. Only its remainder matters, so the
bytes are folded block by block with every intermediate product inside a bigint.
"""

from __future__ import annotations

from itertools import chain, count, islice

from pyspark.sql import Column
from pyspark.sql import functions as F

# Membership hash family ((a * x + b) mod p) mod buckets.
BLOOM_A = (83, 96, 44, 82, 25, 5, 101)
BLOOM_B = 83
BLOOM_P = 233333333333
BLOOM_BUCKETS = 5000
BLOOM_HASHES = 7

# Distinct-count hash family (a * x + b) mod p, coefficients reduced mod p.
FM_P = 233333333
FM_A = (
    92293349, 106073835, 23011172, 213736157, 30805497, 212504684,
    11264739, 184667389, 19324851, 119400483, 7477916, 141366358,
)
FM_B = (
    110622591, 204219772, 36495850, 105613687, 37311918, 183739243,
    196215011, 181999220, 114959837, 91463773, 155009252, 220187013,
)
# Fixed value: trailing zeros of hash 0, which is written with this many digits.
ZERO_HASH_DIGITS = 20


# Texts of up to this many blocks are folded by one generated expression, longer ones as an array.
UNROLLED_BLOCKS = 4


def text_mod(column: str, p: int) -> Column:
    """Remainder modulo ``p`` of the UTF-8 bytes of a text column read as one integer.

    Null for null and for empty text; the work grows with the length of the text. Keep the result in
    a column of its own when several hash functions use it, so that it is computed once.
    """
    return F.expr(text_mod_sql(column, p))


def text_mod_sql(column: str, p: int) -> str:
    """The expression of :func:`text_mod` as SQL."""
    block_bytes = (62 - p.bit_length()) // 8
    digits = 2 * block_bytes
    encoded = f"hex(nullif(`{column}`, ''))"

    def absorb(acc: str, block: str) -> str:
        return f"(({acc}) * {256**block_bytes}L + cast(conv({block}, 16, 10) as bigint)) % {p}L"

    short = f"lpad({encoded}, {UNROLLED_BLOCKS * digits}, '0')"
    folded = "0L"
    for block in range(UNROLLED_BLOCKS):
        folded = absorb(folded, f"substring({short}, {block * digits + 1}, {digits})")
    whole = f"lpad({encoded}, cast(ceil(length({encoded}) / {digits}) as int) * {digits}, '0')"
    blocks = f"regexp_extract_all({whole}, '.{{{digits}}}', 0)"
    long = f"aggregate({blocks}, 0L, (acc, block) -> {absorb('acc', 'block')})"
    return f"CASE WHEN octet_length(`{column}`) <= {UNROLLED_BLOCKS * block_bytes} THEN {folded} ELSE {long} END"


def bloom_coefficients(hashes: int) -> list[int]:
    """The fixed coefficients; further ones are the next integers that aren't among them."""
    more = (a for a in count(2) if a not in BLOOM_A)
    return list(islice(chain(BLOOM_A, more), hashes))


def bloom_positions_of(
    remainder: str, buckets: int = BLOOM_BUCKETS, hashes: int = BLOOM_HASHES
) -> list[str]:
    """The ``hashes`` bit positions below ``buckets`` as SQL, for a ``text_mod(..., BLOOM_P)``
    column."""
    if hashes < 1:
        raise ValueError("there is at least one hash")
    if not 1 <= buckets <= BLOOM_P:
        raise ValueError(f"buckets must lie between 1 and {BLOOM_P}")
    return [
        f"((({remainder} * {a}L + {BLOOM_B}L) % {BLOOM_P}L) % {buckets}L)"
        for a in bloom_coefficients(hashes)
    ]


def trailing_zeros(value: str) -> Column:
    """Trailing zeros of the binary text of a bigint expression."""
    return F.expr(trailing_zeros_sql(value))


def trailing_zeros_sql(value: str) -> str:
    return f"CASE WHEN {value} = 0 THEN {ZERO_HASH_DIGITS} ELSE bit_count(({value} & -{value}) - 1) END"


def fm_hashes_of(remainder: str) -> list[str]:
    """The 12 hashes as SQL, for a ``text_mod(..., FM_P)`` column."""
    return [f"(({remainder} * {a}L + {b}L) % {FM_P}L)" for a, b in zip(FM_A, FM_B)]


def fm_trailing_zeros(remainder: str) -> list[Column]:
    """Trailing zeros under each of the 12 hash functions, for a ``text_mod(..., FM_P)`` column."""
    return [trailing_zeros(h) for h in fm_hashes_of(remainder)]


def binary_text(value: Column) -> Column:
    """Binary digits padded with zeros to 20 places."""
    digits = F.bin(value)
    width = F.greatest(F.length(digits), F.lit(ZERO_HASH_DIGITS))
    return F.lpad(digits, width, F.lit("0"))


def crc_of_first(key: Column) -> Column:
    """CRC-32 of the first character."""
    return F.crc32(F.encode(F.substring(key, 1, 1), "UTF-8"))


def code_of_first(key: Column) -> Column:
    """Code of the first character."""
    return F.ascii(key).cast("bigint")
