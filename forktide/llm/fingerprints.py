"""Document fingerprints by one-permutation MinHash.

The five-word shingles of a text are hashed once. The leading bits of a hash name one of ``BINS``
bins, and a bin keeps its smallest hash. Empty bins are filled by optimal densification: bin ``b``
asks other bins in an order drawn by hashing ``b`` until one is occupied, and takes its value. Of every
bin the lowest ``BITS`` bits are kept, packed as two hex digits a bin. Two fingerprints agree in a bin
by chance with probability ``2 ** -BITS``; the estimate of their Jaccard similarity is corrected for it.

Only DataFrame functions are used. Words are separated by white space; a text of fewer than five words
is one shingle.

Defined results: NULL counts as the empty text, whose one shingle is the empty word; equal texts
have equal fingerprints; an empty table gives an empty result. For ``with_next``, rows follow each
other by key (NULL first), then by text; the row after the last is the first; the only row of a table
follows itself. Columns of the input other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
MASK = (1 << BITS) - 1
FIRST_PROBES = 16
# Rows of one stretch of neighbouring keys, and the most stretches there are.
STRETCH_ROWS = 2_000
MOST_STRETCHES = 4_096


def probe(bin_: Column, attempt: Column) -> Column:
    """The bin that empty bin ``bin_`` asks at an attempt: a universal hash of the two."""
    return F.xxhash64(bin_, attempt).bitwiseAND(F.lit(BINS - 1)).cast("int")


def later_probe(bin_: Column, attempt: Column) -> Column:
    """After the first attempts every bin is asked once, in steps of an odd width drawn for ``bin_``."""
    step = F.xxhash64(bin_).bitwiseAND(F.lit(BINS - 1)).bitwiseOR(F.lit(1))
    return (bin_ + attempt * step).bitwiseAND(F.lit(BINS - 1)).cast("int")


def with_shingle_hashes(df: DataFrame, text: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """Adds the hashes of all shingles of ``text``, in text order."""
    words, hashes = f"_words_{out}", f"_hashes_{out}"
    df = df.withColumn(words, F.split(F.trim(F.coalesce(F.col(text), F.lit(""))), r"\s+"))
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))

    def at(x: Column, i: Column) -> Column:
        return F.xxhash64(x, *[F.get(F.col(hashes), i + k) for k in range(1, shingle)])

    count = F.greatest(F.size(hashes) - (shingle - 1), F.lit(1))
    return df.withColumn(out, F.slice(F.transform(hashes, at), 1, count)).drop(words, hashes)


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the low-order bits of the densified bins, as an array of BINS signed bytes."""
    sorted_, full = f"_sorted_{out}", f"_full_{out}"
    # The largest hash of every bin marks it as empty, if no other hash comes before it.
    value = (1 << (64 - BIN_BITS)) - 1
    marks = F.transform(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        lambda b: F.shiftleft((b - (BINS // 2)).cast("bigint"), 64 - BIN_BITS).bitwiseOR(F.lit(value)),
    )
    df = with_shingle_hashes(df, text, sorted_)
    df = df.withColumn(sorted_, F.sort_array(F.concat(sorted_, marks)))
    least = F.filter(
        F.col(sorted_),
        lambda x, i: (i == 0) | (F.shiftright(x.bitwiseXOR(F.get(F.col(sorted_), i - 1)), 64 - BIN_BITS) != 0),
    )

    def low(x: Column) -> Column:
        bits = (x.bitwiseAND(F.lit(MASK)) - (1 << (BITS - 1))).cast("tinyint")
        return F.when(x.bitwiseAND(F.lit(value)) != F.lit(value), bits)

    df = df.withColumn(full, F.transform(least, low))

    def asked(v: Column, b: Column) -> Column:
        first = [F.get(F.col(full), probe(b, F.lit(t))) for t in range(1, FIRST_PROBES + 1)]
        rest = F.transform(
            F.sequence(F.lit(1), F.lit(BINS)), lambda t: F.get(F.col(full), later_probe(b, t))
        )
        return F.coalesce(v, *first, F.get(F.filter(rest, lambda e: e.isNotNull()), F.lit(0)))

    df = df.withColumn(out, F.transform(F.col(full), asked))
    return df.drop(sorted_, full)


def packed(signature: str) -> Column:
    """A signature as lowercase hex, two digits a bin."""
    two = F.transform(
        signature, lambda v: F.substring(F.hex(v.cast("int") + (1 << (BITS - 1)) + (1 << BITS)), 2, 2)
    )
    return F.lower(F.array_join(two, ""))


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two signatures, 0 to 1, corrected for chance agreement."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    return F.greatest((same - chance) / (1 - chance), F.lit(0.0))


def with_next(
    df: DataFrame, key: str, text: str, columns: list[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Adds ``next_<c>`` for every c of ``columns``: its value in the row with the next key.

    Keys are cut into stretches of some STRETCH_ROWS rows at approximate quantiles, so that no task
    sorts more than a stretch; the first row of a stretch is sent to the stretch before it as well.
    The cuts need not be exact, only ascending. Only the cuts reach the driver. ``prepare`` adds columns
    row by row once the rows to send are chosen, so costly ones are worked out for those alone.
    """
    rows = df.count()
    stretches = min(MOST_STRETCHES, rows // STRETCH_ROWS + 1)
    cuts = []
    if stretches > 1:
        shares = [i / stretches for i in range(1, stretches)]
        found = df.agg(F.percentile_approx(key, shares, 20 * stretches).alias("c")).first()["c"]
        cuts = sorted(set(found or []))
    stretch = F.lit(0)
    if cuts:
        below = F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(key))
        stretch = F.when(F.col(key).isNull(), 0).otherwise(F.size(below))
    placed = df.withColumn("_stretch", stretch)
    firsts = placed.groupBy("_stretch").agg(F.min(F.struct(F.col(key).isNotNull(), key)).alias("f"))
    starts = sorted((r["_stretch"], r["f"][1]) for r in firsts.collect())
    if not starts:
        return prepare(df).withColumns({f"next_{c}": F.col(c) for c in columns})
    # At most MOST_STRETCHES rows: the first key of each stretch, and the stretch before it.
    kind = df.schema[key].dataType
    guests = df.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(k).cast(kind).alias("_first"), F.lit(starts[i - 1][0]).alias("_stretch"))
                    for i, (_, k) in enumerate(starts)
                ]
            )
        )
    )
    extra = df.join(F.broadcast(guests), F.col(key).eqNullSafe(F.col("_first"))).drop("_first")
    both = placed.withColumn("_guest", F.lit(False)).unionByName(extra.withColumn("_guest", F.lit(True)))
    order = Window.partitionBy("_stretch").orderBy("_guest", key, text)
    return (
        prepare(both).withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
        .filter(~F.col("_guest"))
        .drop("_stretch", "_guest")
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``fingerprint``."""
    df = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text))
    return with_signature(df, text, "_sig").select(key, packed("_sig").alias("fingerprint"))


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and how alike they and the next text's are.

    The edited form has the second half (``n_chars // 2`` code points) replaced by as many first
    code points of the next text, or by all of it if it is shorter.
    """
    plain = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = with_next(
        plain, "_key", "_text", ["_text", "_sig"], lambda rows: with_signature(rows, "_text", "_sig")
    )
    half = F.floor(F.length("_text") / 2).cast("int")
    edited = F.concat(
        F.substring("_text", 1, F.length("_text") - half), F.substring(F.col("next__text"), F.lit(1), half)
    )
    df = with_signature(df.withColumn("_edited", edited), "_edited", "_edited_sig")
    return df.select(
        F.col("_key").alias(key),
        F.length("_text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        packed("_sig").alias("fingerprint"),
        packed("_edited_sig").alias("edited_fingerprint"),
        likeness("_sig", "_edited_sig").alias("near_edited"),
        likeness("_sig", "next__sig").alias("near_next"),
    )
