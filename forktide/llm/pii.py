"""Personal data in texts: emails, IP addresses, card and phone numbers.

Base spans are exact: the leftmost non-overlapping matches of a fixed pattern per kind, less those
that fail the kind's check (parts of an address, digits and Luhn sum of a card, digits of a phone).
Beside them, generous patterns propose candidates, which may overlap base spans and each other's.
A candidate is likely if its value, with obfuscations undone, is plausible for the kind (octets, Luhn
sum, digits, top-level domain) and it is either written in the full base form or told by a word of the
kind just before. So a phone without ``+`` or a ``name (at) host (dot) com`` can be likely, and a card
of a wrong Luhn sum cannot. Boosted trees learn this from all candidates of the corpus by format
(digits, separators) and context (characters around, telling word); whether a candidate has the base
form is masked. The threshold of each kind is the lowest at which candidates of a held-out part of the
corpus are likely with ``PRECISION``, all together and those that are no base span by themselves.
Candidates above it are added unless they overlap a base span.

Only DataFrame functions are used, the regular expressions among them; each is linear in the text
and without recursion. Candidates are counted by feature cell, and only the table of cells reaches
the driver; the trees come back as an expression.

Spans are in code points, end exclusive, and written ``kind:start:end``. Defined results: NULL counts
as the empty text, which has no spans; repeated rows get equal results; without candidates nothing is
added; other columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forktide.llm import boosting
from forktide.llm.common import free_names, stored

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.99
LEAST_EXAMPLES = 50
HELD_OUT_OF = 4
SUM_BLOCK = 256

# The patterns of the four kinds. They match what
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+
#   phone \+[0-9][\x20().0-9-]+[0-9]
# match, written without repeated groups (which recurse) and without a second try inside a run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-][A-Za-z0-9.-]*?(?!\.?[A-Za-z0-9-])",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]*?(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without a match of these have no spans of the kind; they only save work.
QUICK = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][0-9\x20-]{14}",
    "phone": r"\+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\x20\.\x20|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9])[0-9]{1,4}(?:[.,]\x20?[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:(?:\+|00)\x20?[0-9]{1,3}[\x20.-]?|[0-9]{1,3}[\x20.-]?)?"
    r"\(?[0-9]{3}(?:\)[\x20.-]?|[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
WIDE_QUICK = {
    "email": r"@|\(at\)|\[at\]",
    "ip": r"[0-9][.,]\x20?[0-9]",
    "card": r"[0-9][0-9\x20.-]{11}[0-9]",
    "phone": r"[0-9]{3}(?:\)[\x20.-]?|[\x20.-])[0-9]{3}[\x20.-][0-9]{4}",
}
# Words that announce a value of the kind, at most 12 characters before it.
TELLING = {
    "email": r"e-?mails?|mailto|mail|contact|write|reach|address|correo|courriel|adresse",
    "ip": r"ip|ipv4|host|hostname|server|address|dns|gateway|adresse|serveur|servidor",
    "card": r"card|visa|mastercard|amex|credit|debit|payment|karte|kreditkarte|carte|tarjeta",
    "phone": r"phone|telephone|tel|call|fax|mobile|cell|contact|dial|telefon|mobil|anruf|tél|teléfono",
}
FEATURES = ("kind", "digits", "others", "plausible", "paren", "before", "after", "telling", "lead")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once: a lambda variable is never expanded again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, v: a + v)


def _found(text: Column, pattern: str, kind: int) -> Column:
    """Matches as structs (kind, start, end, match), in text order.

    A text split at its matches gives the lengths between them; positions are their running sums,
    taken over blocks so that many matches in one text do not cost their square.
    """

    def placed(matches: Column, steps: Column, gaps: Column) -> Column:
        def with_blocks(blocks: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                block = F.floor(i / SUM_BLOCK).cast("int")
                start = (
                    _sum(F.slice(blocks, 1, block))
                    + _sum(F.slice(steps, block * SUM_BLOCK + 1, i - block * SUM_BLOCK))
                    + F.get(gaps, i)
                )
                return F.struct(
                    F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match")
                )

            return F.transform(matches, one)

        last = F.floor(F.size(steps) / SUM_BLOCK).cast("int")
        sums = F.transform(F.sequence(F.lit(0), last), lambda b: _sum(F.slice(steps, b * SUM_BLOCK + 1, SUM_BLOCK)))
        return _let(sums, with_blocks)

    def with_matches(matches: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
        return _let(
            gaps,
            lambda g: _let(F.zip_with(matches, F.slice(g, 1, F.size(matches)), lambda m, x: F.length(m) + x),
                           lambda steps: placed(matches, steps, g)),
        )

    return _let(F.regexp_extract_all(text, F.lit(pattern), 0), with_matches)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(d: Column, i: Column) -> Column:
        v = d.cast("int")
        twice = F.when(v > 4, 2 * v - 9).otherwise(2 * v)
        return F.when((F.length(digits) - i) % 2 == 0, twice).otherwise(v)

    return _sum(F.transform(F.split(digits, "(?!^)(?=.)"), value)) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    """The check of a kind, for a match of its base pattern."""
    digits = _digits(match)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # Leading zeros do not count; what remains is at most three digits and at most 255.
        small = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(small, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15)


def _plausible(kind: str, match: Column) -> Column:
    """Whether a candidate's value is one of the kind, however it is written."""
    digits = _digits(match)
    if kind == "email":
        plain = F.regexp_replace(match, r"\x20?(?:@|\(at\)|\[at\])\x20?", "@")
        plain = F.regexp_replace(plain, r"\x20?(?:\.|\(dot\)|\[dot\])\x20?", ".")
        return plain.rlike(r"^[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*@[A-Za-z0-9][A-Za-z0-9.-]*\.[A-Za-z]{2,}$")
    if kind == "ip":
        return F.forall(F.split(match, r"[.,]\x20?"), lambda p: p.cast("int") <= 255)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15) & ~digits.rlike(r"^([0-9])\1*$")


_SPAN = "array<struct<kind:int,start:int,end:int>>"


def base_spans(text: Column, kind: str) -> Column:
    """Base spans of one kind, in text order."""
    found = F.filter(_found(text, BASE[kind], KINDS.index(kind)), lambda s: _passes(kind, s["match"]))
    spans = F.transform(found, lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return F.when(text.rlike(QUICK[kind]), spans.cast(_SPAN)).otherwise(F.array().cast(_SPAN))


def _class(c: Column) -> Column:
    return (
        F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[0-9]"), 3)
        .when(c.rlike("[\"'=:]"), 4).otherwise(5)
    )


_CANDIDATE = "array<struct<kind:int,start:int,end:int,passes:boolean,likely:boolean,x:array<int>>>"


def candidates(text: Column, kind: str) -> Column:
    """Proposed spans of one kind: features, whether they pass the kind's check, whether they are likely."""
    number = KINDS.index(kind)

    def described(s: Column) -> Column:
        match, start, end = s["match"], s["start"], s["end"]
        digits = F.length(_digits(match))
        before = F.when(start == 0, "").otherwise(F.substring(text, start, F.lit(1)))
        context = F.substring(text, F.greatest(start - 23, F.lit(1)), F.least(start, F.lit(24)))
        told = context.rlike(rf"(?iU)(?<!\w)(?:{TELLING[kind]})(?!\w)[^\n]{{0,12}}$")
        exact = match.rlike(f"^(?:{BASE[kind]})$")

        def complete(plausible: Column) -> Column:
            # The sign and what only it allows before it are left out: they would give the base form away.
            x = F.array(
                F.lit(number),
                F.least(digits, F.lit(20)),
                F.least(F.length(F.regexp_replace(match, r"[0-9+]", "")), F.lit(12)),
                plausible.cast("int"),
                F.contains(match, F.lit("(")).cast("int"),
                _class(before),
                _class(F.substring(text, end + 1, F.lit(1))),
                told.cast("int"),
                F.coalesce(F.substring(_digits(match), 1, 1).try_cast("int"), F.lit(10)),
            )
            return F.struct(
                F.lit(number).alias("kind"), start.alias("start"), end.alias("end"),
                (exact & _passes(kind, match)).alias("passes"), (plausible & (exact | told)).alias("likely"), x.alias("x"),
            )

        return _let(F.coalesce(_plausible(kind, match), F.lit(False)), complete)

    found = F.transform(_found(text, WIDE[kind], number), described).cast(_CANDIDATE)
    return F.when(text.rlike(WIDE_QUICK[kind]), found).otherwise(F.array().cast(_CANDIDATE))


@dataclass(frozen=True)
class Selector:
    trees: boosting.Trees | None
    thresholds: tuple[float, ...]  # by kind; above 1: nothing is added


def proposals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``_row`` (hash of the text), ``base`` and ``candidates``, as a stored table."""
    value = F.coalesce(F.col("_text"), F.lit(""))
    plain = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    found = plain.select(
        "_key",
        F.xxhash64("_text").alias("_row"),
        F.concat(*[base_spans(value, k) for k in KINDS]).alias("base"),
        F.concat(*[candidates(value, k) for k in KINDS]).alias("candidates"),
    )
    return stored(docs.sparkSession, found, "proposals")


def learn(found: DataFrame) -> Selector:
    """Trees and thresholds from all candidates of ``proposals``."""
    each = found.select(
        (F.pmod(F.xxhash64(F.lit("held out"), "_key"), F.lit(HELD_OUT_OF)) == 0).alias("held"),
        F.explode("candidates").alias("c"),
    )
    cells = (
        each.groupBy("held", F.col("c.x").alias("x"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("c.likely").cast("int")).alias("y"),
            F.sum((~F.col("c.passes")).cast("int")).alias("n_new"),
            F.sum((~F.col("c.passes") & F.col("c.likely")).cast("int")).alias("y_new"),
        )
        .collect()
    )
    if not cells:
        return Selector(None, (2.0,) * len(KINDS))
    cells.sort(key=lambda r: (r["held"], r["x"]))
    x = np.array([r["x"] for r in cells])
    n, y = np.array([r["n"] for r in cells], float), np.array([r["y"] for r in cells], float)
    n_new, y_new = np.array([r["n_new"] for r in cells], float), np.array([r["y_new"] for r in cells], float)
    held = np.array([r["held"] for r in cells])
    if held.all() or not held.any():
        return Selector(None, (2.0,) * len(KINDS))
    trees = boosting.fit(x[~held], n[~held], y[~held])
    p = boosting.probabilities(trees, x[held])
    thresholds = []
    for kind in range(len(KINDS)):
        own = x[held][:, 0] == kind
        order = np.argsort(-p[own], kind="stable")
        score, many, good = p[own][order], np.cumsum(n[held][own][order]), np.cumsum(y[held][own][order])
        many_new, good_new = np.cumsum(n_new[held][own][order]), np.cumsum(y_new[held][own][order])
        sure = (good >= PRECISION * many) & (good_new >= PRECISION * many_new)
        fine = np.flatnonzero(sure & (many >= LEAST_EXAMPLES))
        # Cells of equal score are taken together.
        fine = [i for i in fine if i + 1 == len(score) or score[i + 1] < score[i]]
        thresholds.append(float(score[fine[-1]]) - 1e-12 if len(fine) else 2.0)
    return Selector(trees, tuple(thresholds))


def select(found: DataFrame, selector: Selector) -> DataFrame:
    """Adds ``spans`` to ``proposals``: base spans and selected candidates, by kind and start."""
    if selector.trees is None:
        return found.withColumn("spans", F.sort_array("base"))
    limits = F.array(*[F.lit(t) for t in selector.thresholds])

    def chosen(c: Column) -> Column:
        p = boosting.expression(selector.trees, [F.get(c["x"], F.lit(i)) for i in range(len(FEATURES))])
        return ~c["passes"] & (p >= F.get(limits, c["kind"]))

    extra = F.filter(
        F.filter("candidates", chosen),
        lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )
    extra = F.transform(extra, lambda c: F.struct(c["kind"], c["start"], c["end"])).cast(_SPAN)
    return found.withColumn("spans", F.sort_array(F.concat("base", extra)))


def count_of(kind: str, spans: str) -> Column:
    """Number of spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(one, ",")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``_row``, ``base`` and ``spans`` (arrays of kind number, start and end)."""
    found = proposals(docs, key, text)
    return select(found, learn(found)).select(F.col("_key").alias(key), "_row", "base", "spans")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; other columns stay.

    Where spans of several kinds overlap, the text is cut at the first and goes on after the last.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    found = proposals(docs, key, text)
    spans = select(found, learn(found)).filter(F.size("spans") > 0)
    # Names that no column of ``docs`` has.
    k, r, own, kept = free_names(docs, n=4)
    spans = spans.select(
        F.col("_key").alias(k), F.col("_row").alias(r), F.col("spans").alias(kept)
    ).dropDuplicates([k, r])
    rows = docs.withColumn(own, F.xxhash64(text))
    joined = rows.join(spans, F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(r)), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(
        F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        between = F.substring(value, a["at"] + 1, s["start"] - a["at"])
        shown = F.when(s["start"] >= a["at"], F.concat(a["out"], between, F.get(names, s["kind"]))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), shown.alias("out"))

    whole = F.aggregate(
        by_start, start, step, lambda a: F.concat(a["out"], F.substring(value, a["at"] + 1, F.length(value)))
    )
    return joined.withColumn(text, F.when(F.col(kept).isNull(), F.col(text)).otherwise(whole)).select(*docs.columns)
