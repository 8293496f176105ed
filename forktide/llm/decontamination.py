"""Finding benchmark passages in documents by spaced-seed hashing.

A mask is a list of word offsets; the words it skips may differ. At every word of every document and
of every benchmark item the words under each mask are hashed, and equal hashes are joined. A hit puts
the two texts side by side: document word ``p`` against item word ``q`` for one difference ``p - q``.
There the words are compared one by one. With ``by_share``, as the queries use it, the longest stretch is
taken that begins and ends with equal words and of which at least ``MIN_SHARE`` are equal; it counts from
``MIN_WORDS`` words. An item of at most ``MIN_WORDS`` words has to be there as a whole, three quarters of
its words equal, whichever. Without ``by_share`` it is the best stretch that scores +1 for an equal and
-3 for a different word, of the same least length and share; it ends where every fourth word differs.

The masks leave one residue free modulo 3, 4 and 5, so a passage of which every fourth or fifth word was
replaced still has seeds. With ``by_share``, items of at most ``MIN_WORDS`` words are also cut into one
block more than words may differ; one block is always whole, and its hash finds the item.

Only DataFrame functions are used. The item side is broadcast only if it has at most
``BROADCAST_SEEDS`` seeds, which is counted first; otherwise the hashes are shuffled.

Words are runs of letters and digits, in lower case. Defined results: NULL and empty texts hold
nothing; without ``by_share``, items of fewer words than the shortest mask cannot be found; repeated rows
are reported once; rows and items without key are searched, and reported with a NULL key; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.llm.common import free_names

MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 4, 6), (0, 2, 3, 6, 8))
MIN_WORDS = 10
MIN_SHARE = 0.75
BROADCAST_SEEDS = 400_000
NEVER = 1 << 29


def words_of(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable is never expanded again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(hashes: Column, number: int, first: Column, i: Column) -> Column:
    """Hash under one mask at word ``i``; at the end of a text the mask holds fewer words."""
    return F.xxhash64(F.lit(number), first, *[F.get(hashes, i + o) for o in MASKS[number][1:]])


def _seeds(hashes: Column, number: int) -> Column:
    return F.transform(hashes, lambda first, i: _seed(hashes, number, first, i))


def _blocks(size: int) -> list[tuple[int, int]]:
    """Start and length of the blocks of a short item: one more than words of it may differ."""
    many = int(size * (1 - MIN_SHARE)) + 1
    cuts = [size * n // many for n in range(many + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _block_seed(hashes: Column, length: int, first: Column, i: Column) -> Column:
    return F.xxhash64(F.lit(-length), first, *[F.get(hashes, i + o) for o in range(1, length)])


def _inside(number: int) -> Callable[[Column], Column]:
    """Seeds under one mask where all of the mask lies within the text."""
    last = MASKS[number][-1]
    return lambda hashes: F.slice(_seeds(hashes, number), 1, F.greatest(F.size(hashes) - last, F.lit(0)))


def _all_seeds(lengths: list[int]) -> Callable[[Column], Column]:
    """Seeds under all masks and of all blocks of the given lengths, for every word the same number."""

    def at(hashes: Column, first: Column, i: Column) -> Column:
        seeds = [_seed(hashes, n, first, i) for n in range(len(MASKS))]
        return F.array(*seeds, *[_block_seed(hashes, length, first, i) for length in lengths])

    return lambda hashes: F.flatten(F.transform(hashes, lambda first, i: at(hashes, first, i)))


def item_words(text: str) -> Column:
    return F.filter(words_of(text), lambda w: w != "")


def _item_no(key: str, text: str) -> Column:
    """A number for every distinct item, with or without key."""
    return F.xxhash64(F.col(key).isNull(), key, text)


def item_seeds(items: DataFrame, key: str, text: str, short: list[int]) -> DataFrame:
    """Seeds of the items: ``_no``, ``_at`` and ``_seed``; masks stay within the item.

    Items of as many words as one of ``short`` also have the seeds of their blocks.
    """
    number_of = _item_no(key, text).alias("_no")
    out = None
    for number in range(len(MASKS)):
        seeds = _let(_hashes(item_words(text)), _inside(number))
        part = items.select(number_of, F.posexplode(seeds).alias("_at", "_seed"))
        out = part if out is None else out.union(part)
    hashes = items.select(number_of, _hashes(item_words(text)).alias("_hashes"))
    for size in short:
        rows = hashes.filter(F.size("_hashes") == size)
        for start, length in _blocks(size):
            first = F.get("_hashes", F.lit(start))
            seed = _block_seed(F.col("_hashes"), length, first, F.lit(start))
            out = out.union(rows.select("_no", F.lit(start).alias("_at"), seed.alias("_seed")))
    return out.distinct()


def _best_stretch(equal: Column) -> Column:
    """Struct (score, first, last) of the best scored stretch of an array of booleans."""
    start = F.struct(
        F.lit(0).alias("i"), F.lit(0).alias("run"), F.lit(0).alias("since"),
        F.lit(0).alias("score"), F.lit(0).alias("first"), F.lit(-1).alias("last"),
    )

    def step(a: Column, e: Column) -> Column:
        fresh = a["run"] <= 0
        run = F.when(fresh, F.lit(0)).otherwise(a["run"]) + F.when(e, F.lit(1)).otherwise(F.lit(-3))
        since = F.when(fresh, a["i"]).otherwise(a["since"])
        better = run > a["score"]
        return F.struct(
            (a["i"] + 1).alias("i"), run.alias("run"), since.alias("since"),
            F.when(better, run).otherwise(a["score"]).alias("score"),
            F.when(better, since).otherwise(a["first"]).alias("first"),
            F.when(better, a["i"]).otherwise(a["last"]).alias("last"),
        )

    return F.aggregate(equal, start, step)


def _lowest(equal: Column) -> Column:
    """At every word the lowest score before an equal word up to here; all words score from 0."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(NEVER).alias("low"), F.array().cast("array<int>").alias("lows"))

    def step(a: Column, e: Column) -> Column:
        low = F.when(e, F.least(a["low"], a["sum"])).otherwise(a["low"])
        after = a["sum"] + F.when(e, F.lit(1)).otherwise(F.lit(-3))
        return F.struct(after.alias("sum"), low.alias("low"), F.concat(a["lows"], F.array(low)).alias("lows"))

    return F.aggregate(equal, start, step)


def _longest_stretch(equal: Column) -> Column:
    """Struct (score, first, last) of the longest stretch between equal words of at least three quarters.

    Words score +1 or -3, so a stretch is long enough in share if its score is not negative. One end
    moves on while such a stretch can reach it, and the other when it cannot.
    """
    begin = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("score"), F.lit(0).alias("first"), F.lit(-1).alias("last"))

    def walked(ahead: Column, back: Column) -> Column:
        n = F.size(equal)

        def step(a: Column, _: Column) -> Column:
            i, j = a["i"], a["j"]
            reached = F.get(ahead["lows"], i) + F.get(back["lows"], n - 1 - j) <= ahead["sum"]
            more = (j < n) & reached
            longer = more & (j - i + 1 > a["score"])
            return F.struct(
                F.when(more | (j >= n), i).otherwise(i + 1).alias("i"),
                F.when(more, j + 1).otherwise(j).alias("j"),
                F.when(longer, j - i + 1).otherwise(a["score"]).alias("score"),
                F.when(longer, i).otherwise(a["first"]).alias("first"),
                F.when(longer, j).otherwise(a["last"]).alias("last"),
            )

        return F.aggregate(F.concat(equal, equal), begin, step)

    return _let(_lowest(equal), lambda ahead: _let(_lowest(F.reverse(equal)), lambda back: walked(ahead, back)))


def overlaps(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", by_share: bool = False,
) -> DataFrame:
    """Verified overlaps, one row per document and item: the longest.

    Columns: key, ``item_id``, ``n_words`` of the stretch, ``n_equal`` of them, ``doc_word`` and
    ``item_word``, the word numbers (from 0) where it begins.
    """
    short: list[int] = []
    if by_share:
        size = F.size(item_words(item_text)).alias("n")
        sizes = items.select(size).distinct().filter(F.col("n").between(1, MIN_WORDS))
        short = sorted(r["n"] for r in sizes.collect())
    lengths = sorted({length for size in short for _, length in _blocks(size)})
    seeds = item_seeds(items, item_key, item_text, short)
    small = seeds.count() <= BROADCAST_SEEDS
    sizes = items.select(
        _item_no(item_key, item_text).alias("_no"), F.col(item_key).alias("item_id"), item_words(item_text).alias("_item")
    ).distinct()
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_row"), F.col(text).alias("_text"))
    at = rows.select(
        "_key", "_row", F.posexplode(_let(_hashes(words_of("_text")), _all_seeds(lengths))).alias("_pos", "_seed")
    )
    hits = (
        at.join(F.broadcast(seeds) if small else seeds, "_seed")
        .select(
            F.col("_key").alias("_k"), F.col("_row").alias("_r"), "_no",
            (F.floor(F.col("_pos") / (len(MASKS) + len(lengths))).cast("int") - F.col("_at")).alias("_diff"),
        )
        .distinct()
    )
    # Only documents with a hit are cut into words again; words beside the item are compared.
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r"))
    hits = hits.join(F.broadcast(sizes) if small else sizes, "_no")
    per_row = hits.groupBy("_k", "_r").agg(F.collect_list(F.struct("item_id", "_diff", "_item")).alias("_hits"))
    beside = rows.join(per_row, same)
    found = _let(
        words_of("_text"),
        lambda words: F.filter(F.transform("_hits", lambda hit: _verified(hit, words, by_share)), lambda f: f["good"]),
    )
    longest = F.max(F.struct("n_equal", "n_words", "before_doc", "before_item")).alias("_m")
    return (
        beside.select(F.col("_key").alias(key), F.explode(found).alias("_found"))
        .select(key, "_found.*")
        .groupBy(key, "item_id")
        .agg(longest)
        .select(
            key,
            "item_id",
            F.col("_m.n_words").cast("bigint").alias("n_words"),
            F.col("_m.n_equal").cast("bigint").alias("n_equal"),
            (-F.col("_m.before_doc")).cast("bigint").alias("doc_word"),
            (-F.col("_m.before_item")).cast("bigint").alias("item_word"),
        )
    )


def _verified(hit: Column, words: Column, by_share: bool) -> Column:
    """The best stretch of a document's words beside an item, and whether it is long and equal enough."""
    diff, item = hit["_diff"], hit["_item"]
    doc_start, item_start = F.greatest(diff, F.lit(0)), F.greatest(-diff, F.lit(0))
    room = F.size(item) - item_start
    if by_share:
        # A text that ends with another character than a letter or digit has an empty last word.
        room = F.least(room, F.size(words) - doc_start - (F.element_at(words, -1) == "").cast("int"))
        room = F.greatest(room, F.lit(0))
    equal = F.zip_with(
        F.slice(words, doc_start + 1, room),
        F.slice(item, item_start + 1, room),
        lambda a, b: F.coalesce(a == b, F.lit(False)),
    )

    def best_of(e: Column) -> Column:
        if not by_share:
            return _best_stretch(e)
        whole = F.struct(F.size(e).alias("score"), F.lit(0).alias("first"), (F.size(e) - 1).alias("last"))
        longest = _let(_longest_stretch(e), lambda b: F.struct(b["score"], b["first"], b["last"]))
        return F.when(F.size(item) <= MIN_WORDS, whole).otherwise(longest)

    def measured(e: Column, best: Column) -> Column:
        length = best["last"] - best["first"] + 1
        n_equal = F.size(F.filter(F.slice(e, best["first"] + 1, length), lambda x: x))
        long_enough = length >= F.least(F.lit(MIN_WORDS), F.size(item))
        return F.struct(
            hit["item_id"].alias("item_id"), length.alias("n_words"), n_equal.alias("n_equal"),
            (-(doc_start + best["first"])).alias("before_doc"), (-(item_start + best["first"])).alias("before_item"),
            ((best["score"] > 0) & long_enough & (n_equal >= F.lit(MIN_SHARE) * length)).alias("good"),
        )

    return _let(equal, lambda e: _let(best_of(e), lambda best: measured(e, best)))


def clean(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", by_share: bool = False
) -> DataFrame:
    """Rows of ``docs`` without the documents that hold a benchmark passage."""
    (name,) = free_names(docs, n=1)
    leaked = overlaps(docs, items, key, text, by_share=by_share).select(F.col(key).alias(name)).distinct()
    return docs.join(leaked, F.col(key).eqNullSafe(F.col(name)), "left_anti")
