"""Unsigned 256-bit integers as zero-padded decimal text (F10, A5, value part of P5).

Spark decimals stop at 38 digits, so a value is kept as 78 digits of text: text order is then
numeric order. Sums and conversions work on limbs, smaller pieces of those digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.functions.text import strip_hex

DIGITS = 78
MOST = 2**256 - 1
HEX_DIGITS = 64
SUM_LIMB = 6
PIECE = 18
HEX_LIMB = 18
WORD = 15


def zero_filled(c: Column, digits: int) -> Column:
    """Leading zeros up to ``digits``, which the text must not exceed; half the cost of lpad."""
    return F.substring(F.concat(F.lit("0" * digits), c), -digits, digits)


def _checked(text: Column, good: Column, value: Column) -> Column:
    """``value`` where the text is good, NULL where it is NULL, an error where it is anything else."""
    problem = F.raise_error(F.concat(F.lit("not an unsigned 256-bit integer: "), text))
    return F.when(text.isNull(), F.lit(None).cast("string")).when(good, value).otherwise(problem)


def pad(c: Column) -> Column:
    """78 digits of decimal text; an error for other text and for values above 2^256 - 1."""
    text = c.cast("string")
    filled = zero_filled(text, DIGITS)
    good = (F.length(text) <= DIGITS) & (F.length(text) > 0)
    good = good & (F.translate(text, "0123456789", "") == "") & (filled <= F.lit(str(MOST)))
    return _checked(text, good, filled)


def unpad(c: Column) -> Column:
    trimmed = F.ltrim(c, F.lit("0"))
    return F.when(trimmed == "", F.lit("0")).otherwise(trimmed)


def _dec(n: int, precision: int) -> Column:
    return F.lit(str(n)).cast(f"decimal({precision},0)")


def _text(c: Column, digits: int) -> Column:
    return zero_filled(c.cast(f"decimal({digits},0)").cast("string"), digits)


def sum_u256(padded: Column) -> Column:
    """Exact SUM as an aggregate expression; the total is decimal text and does not wrap.

    Bigint sums of six digits each: they aggregate partially before the shuffle, in generated code.
    A sum overflows, with an error, after 9 * 10^12 rows of 2^256-1 in one group. Text is parsed 18
    digits at a time, and the 42 leading digits only where they are not all zero. Only the totals
    are put together in decimals, four limbs to a part.
    """
    upper = 42
    small = F.substring(padded, 1, upper) == F.lit("0" * upper)
    sums = []
    for start in range(DIGITS - PIECE + 1, -PIECE, -PIECE):
        size = PIECE if start > 0 else PIECE + start - 1
        piece = F.substring(padded, max(start, 1), size).cast("bigint")
        if start <= upper:
            piece = F.when(small, F.lit(0)).otherwise(piece)
        for place in range(0, size, SUM_LIMB):
            limb = F.call_function("div", piece, F.lit(10**place).cast("bigint"))
            sums.append(F.sum(limb % F.lit(10**SUM_LIMB)))
    part_digits = 4 * SUM_LIMB
    base = _dec(10**part_digits, part_digits + 1)
    texts, carry = [], F.lit(0)
    for first in range(0, len(sums), 4):
        part = carry.cast("decimal(38,0)")
        for place, limb in enumerate(sums[first : first + 4]):
            part = part + limb.cast("decimal(19,0)") * _dec(10 ** (SUM_LIMB * place), 19)
        part = part.cast("decimal(38,0)")
        last = first + 4 >= len(sums)
        texts.append(part.cast("string") if last else _text(part % base, part_digits))
        carry = F.call_function("div", part, base)
    return unpad(F.concat(*reversed(texts)))


def fits_u256(total: Column) -> Column:
    """False where a total is larger than 2^256 - 1."""
    return (F.length(total) <= DIGITS) & (zero_filled(total, DIGITS) <= F.lit(str(MOST)))


def with_u256(df: DataFrame, out: str, hex_text: Column) -> DataFrame:
    """Adds up to 64 hex digits, with or without ``0x``, as padded decimal text; an error for other text.

    Values below 2^120 are one decimal. For larger ones five words of 60 bits are multiplied by the
    limbs of their powers of two and summed; no intermediate has more than 38 digits, and all are
    NULL, which costs nothing, for the small ones. The steps are separate projections, so that each
    intermediate is computed once.
    """
    base = _dec(10**HEX_LIMB, HEX_LIMB + 1)
    n_limbs, n_words = -(-DIGITS // HEX_LIMB), -(-64 // WORD)
    plain_hex = strip_hex(hex_text)
    is_hex = F.translate(plain_hex, "0123456789abcdefABCDEF", "") == ""
    digits = _checked(
        plain_hex, (F.length(plain_hex) <= HEX_DIGITS) & is_hex, zero_filled(plain_hex, n_words * WORD)
    )
    upper = (n_words - 2) * WORD
    large = F.col("_large")

    def word(i: int) -> Column:
        text = F.substring("_digits", (n_words - i - 1) * WORD + 1, WORD)
        value = F.conv(text, 16, 10).cast("decimal(19,0)")
        return value if i < 2 else F.when(large, value)

    words = (
        df.withColumn("_digits", digits)
        .withColumn("_large", F.substring("_digits", 1, upper) != F.lit("0" * upper))
        .withColumns({f"_w{i}": word(i) for i in range(n_words)})
    )
    limbs = {}
    for j in range(n_limbs):
        total = F.when(large, F.lit(0).cast("decimal(38,0)"))
        for i in range(n_words):
            factor = (2 ** (4 * WORD * i) // 10 ** (HEX_LIMB * j)) % 10**HEX_LIMB
            if factor:
                total = total + F.col(f"_w{i}") * _dec(factor, HEX_LIMB)
        limbs[f"_s{j}"] = total.cast("decimal(38,0)")
    parts = words.withColumns(limbs)
    for j in range(n_limbs - 1):
        carry = F.call_function("div", F.col(f"_s{j}"), base)
        parts = parts.withColumn(f"_s{j + 1}", (F.col(f"_s{j + 1}") + carry).cast("decimal(38,0)"))
    text = F.concat(
        *[_text(F.col(f"_s{j}") % base, HEX_LIMB) for j in reversed(range(n_limbs))]
    )
    scratch = ["_digits", "_large", *[f"_w{i}" for i in range(n_words)], *limbs]
    start = n_limbs * HEX_LIMB - DIGITS + 1
    plain = F.col("_w1") * _dec(2 ** (4 * WORD), 19) + F.col("_w0")
    value = F.when(large, F.substring(text, start, DIGITS)).otherwise(
        zero_filled(plain.cast("decimal(38,0)").cast("string"), DIGITS)
    )
    return parts.withColumn(out, value).drop(*scratch)
