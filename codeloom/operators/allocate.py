"""Grading matches by fan-out and splitting record weights across them.

Mass is conserved: over matched records, the adjusted weights of one record
sum back to its weight, since each of its ``n_targets`` rows carries
``weight / n_targets``.  Unmatched records are kept once with NULL target and
NULL adjusted weight.

Scale notes
-----------
* Records meet the concordance through a lookup keyed by the *raw* code
  (cleaning and classification ran once per distinct code).  The lookup is
  small (distinct codes x targets); it is materialized into the shared
  checkpoint folder and broadcast behind a row-count check, so the records
  are never shuffled.  Beyond the bound, ``skew_safe_join`` salts the hot
  codes exactly.
* ``allocate_totals`` reduces records to one row per code *before* any join
  (map-side combine), so hot codes cost nothing extra; with
  ``allocate_totals_from_stats`` the same per-code stats also feed the
  matcher, and the records are read once.  Sums of integral weights are
  exact and divided once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codeloom.functions.classify import rank_of
from codeloom.operators.broadcast import known_rows, max_broadcast_rows, observed, sized_broadcast, skew_safe_join, with_size
from codeloom.operators.codes import drop_codes_filter
from codeloom.operators.match import DROP_CODES, EXACT, MANUAL, PERSON_RANKS, PREFIX_LENGTHS, longest_keys, matched_entries
from codeloom.operators.nested import fanned_out, first_per, nested

# Grading of a concordance row.  Exact and manual rows are
# clean; others by the fan-out of their code: <= 4 acceptable, <= 15 coarse,
# above unusable.
CLEAN_TYPES = (EXACT, MANUAL)
ACCEPTABLE_MAX = 4
COARSE_MAX = 15


def fanout(conc: DataFrame, code: str = "code", target: str = "target",
           out: str = "n_targets") -> DataFrame:
    """H2: number of distinct targets per code."""
    return conc.groupBy(code).agg(F.count_distinct(target).alias(out))


def grade_matches(conc: DataFrame, code: str = "code", target: str = "target",
                  clean_types: Sequence[str] = CLEAN_TYPES, acceptable_max: int = ACCEPTABLE_MAX,
                  coarse_max: int = COARSE_MAX) -> DataFrame:
    """Attach ``n_targets`` (fan-out of the code) and ``match_quality``.

    Grading is per row: one code with an override and a prefix match (D5)
    can hold two tiers.  The fan-out is a per-code window (groups are bounded
    by the number of targets), equal to joining the ``fanout`` aggregate back.
    """
    n = F.size(F.collect_set(target).over(Window.partitionBy(code))).cast("long")
    return conc.withColumn("n_targets", n).withColumn(
        "match_quality", _quality(clean_types, acceptable_max, coarse_max))


def _quality_of(match_type: F.Column, n: F.Column, clean_types: Sequence[str], acceptable_max: int, coarse_max: int) -> F.Column:
    return (F.when(match_type.isin(list(clean_types)), F.lit("clean"))
            .when(n <= acceptable_max, F.lit("acceptable"))
            .when(n <= coarse_max, F.lit("coarse"))
            .otherwise(F.lit("unusable")))


def _quality(clean_types: Sequence[str], acceptable_max: int, coarse_max: int) -> F.Column:
    return _quality_of(F.col("match_type"), F.col("n_targets"), clean_types, acceptable_max, coarse_max)


def best_graded(matches: DataFrame, ranks: dict[str, int] = PERSON_RANKS,
                clean_types: Sequence[str] = CLEAN_TYPES, acceptable_max: int = ACCEPTABLE_MAX,
                coarse_max: int = COARSE_MAX) -> DataFrame:
    """E7 + E8: best row per (code, target), fan-out, grade.

    The best row is a minimum per (code, target) (the same total order as
    ``best_match`` with tie-breaks ``match_type, multi_io``), combined before
    its shuffle.  What is then gathered per code has one entry per target, so
    a group is bounded by the targets, however many dictionary rows match.
    """
    best = matches.groupBy("code", "target").agg(F.min(F.struct(
        rank_of("match_type", ranks).alias("rank"), "match_type", "multi_io")).alias("__m"))
    per = best.groupBy("code").agg(F.collect_list(F.struct("target", "__m")).alias("__b"))
    out = per.select("code", F.size("__b").cast("long").alias("n_targets"), F.explode("__b").alias("__t"))
    return out.select("code", "__t.target", "__t.__m.multi_io", "__t.__m.match_type", "n_targets") \
        .withColumn("match_quality", _quality(clean_types, acceptable_max, coarse_max))


_GRADED = ["code", "target", "multi_io", "match_type", "n_targets", "match_quality"]


def graded_lists(codes: DataFrame, keys: DataFrame, overrides: DataFrame | None,
                 drop_codes: Sequence[str] = DROP_CODES, lengths: Sequence[int] = PREFIX_LENGTHS, width: int = 6,
                 blocks: bool = False, ranks: dict[str, int] = PERSON_RANKS,
                 clean_types: Sequence[str] = CLEAN_TYPES, acceptable_max: int = ACCEPTABLE_MAX,
                 coarse_max: int = COARSE_MAX) -> DataFrame:
    """E5 to E8 as one row per matched code: ``(code, n_targets, matches)``, ``matches`` an array of
    ``(target, multi_io, match_type, match_quality)`` with one entry per target, sorted by target.

    ``keys`` (``match.nested_keys``) hold one entry per target already, and all entries of a code's
    longest length have one match type, so there is nothing left to group: no shuffle by code or
    (code, target) follows the cascade.  Only the codes of the literal ``overrides`` sort two short
    arrays together.  Rows as in ``best_graded``, see :func:`graded_rows`.
    """
    found = matched_entries(drop_codes_filter(codes, drop_codes), keys, lengths, width, blocks)
    own_type = F.when(F.col("L") == width, F.lit(EXACT)).otherwise(F.concat(F.lit("prefix_"), F.col("L").cast("string"), F.lit("d")))
    d = found.withColumn("match_type", own_type).withColumn("n_targets", F.size("entries").cast("long"))
    tier = lambda t: _quality_of(t, F.col("n_targets"), clean_types, acceptable_max, coarse_max)
    listed = lambda x, t, q: F.struct(x["target"].alias("target"), x["multi_io"].alias("multi_io"), t.alias("match_type"), q.alias("match_quality"))
    # all entries of a code have its tier, so its grade is computed once per code
    plain = F.transform("entries", lambda x: listed(x, F.col("match_type"), F.col("match_quality")))
    if overrides is None:
        return d.where("n_targets > 0").withColumn("match_quality", tier(F.col("match_type"))).select("code", "n_targets", plain.alias("matches"))
    entry = ["target", "rank", "match_type", "multi_io"]
    extra = overrides.withColumn("rank", rank_of("match_type", ranks)).groupBy("code").agg(F.collect_set(F.struct(*entry)).alias("extra"))
    d = d.join(sized_broadcast(extra, bound=known_rows(overrides)), "code", "left").withColumn("rank", rank_of("match_type", ranks))
    both = F.array_sort(F.concat(F.transform("entries", lambda x: F.struct(
        x["target"].alias("target"), F.col("rank").alias("rank"), F.col("match_type").alias("match_type"), x["multi_io"].alias("multi_io"))), "extra"))
    d = first_per(d.withColumn("both", F.when(F.col("extra").isNotNull(), both)), "both", "target")
    d = d.withColumn("n_targets", F.when(F.col("both").isNotNull(), F.size("both").cast("long")).otherwise(F.col("n_targets"))).where("n_targets > 0")
    mixed = F.transform("both", lambda x: listed(x, x["match_type"], tier(x["match_type"])))
    d = d.withColumn("match_quality", tier(F.col("match_type")))
    return d.select("code", "n_targets", F.when(F.col("both").isNull(), plain).otherwise(mixed).alias("matches"))


def graded_rows(lists: DataFrame) -> DataFrame:
    """The rows of :func:`graded_lists`, one per (code, target)."""
    return fanned_out(lists, "matches").select(*_GRADED)


def as_lists(graded: DataFrame) -> DataFrame:
    """Graded rows as lists (a code's group is bounded by the targets); lists as they are."""
    return graded if "matches" in graded.columns else nested(graded, ["code", "n_targets"], "matches", bounded=True)


def sample_lists(lists: DataFrame, tiers: Sequence[str] | None = ("clean", "acceptable"), single_target_only: bool = False) -> DataFrame:
    """E13 on :func:`graded_lists`: the entries of the chosen tiers; a code without any goes."""
    d = lists.where(F.col("n_targets") == 1) if single_target_only else lists
    if tiers is not None:
        d = d.withColumn("matches", F.filter("matches", lambda x: x["match_quality"].isin(list(tiers)))).where(F.size("matches") > 0)
    return d


def code_lookup(cmap: DataFrame, graded: DataFrame, drop_codes: Sequence[str] = DROP_CODES,
                max_broadcast_rows: int | None = None, materialize: bool = True) -> DataFrame:
    """Raw code -> cleaned code, classes, fan-out and the array ``matches`` of its graded rows.

    One row per raw code.  Only kept codes not in ``drop_codes`` appear; an unmatched
    kept code has a NULL array.  With ``materialize`` (before a join with the
    records) it is written to the shared checkpoint folder and broadcast
    when within the row bound, so the records are never shuffled; beyond
    the bound AQE's skew-aware shuffle join takes over.
    """
    keep = drop_codes_filter(cmap.where("keep"), drop_codes, "code_str").drop("keep")
    lk = keep.join(as_lists(graded).withColumnRenamed("code", "code_str"), "code_str", "left")
    return sized_broadcast(lk, max_broadcast_rows, materialize_first=materialize)


def allocate(facts: DataFrame, cmap: DataFrame, graded: DataFrame, code: str = "code",
             weight: str = "wt", out: str = "wt_adj", drop_codes: Sequence[str] = DROP_CODES,
             max_broadcast_rows: int | None = None, stats: DataFrame | None = None,
             record_key: Sequence[str] = ()) -> DataFrame:
    """Records x graded concordance (left), ``out = weight / n_targets``.

    Records whose code is NULL, not-employed or dropped are removed (C4, C5);
    a record matched to k targets becomes k rows; an unmatched record stays
    once with NULL target and NULL ``out``.  The lookup (one row per raw code, its
    matches nested) is materialized and broadcast when within the row bound, so the
    records are never shuffled, and a record finds one row and fans out above the join.
    Beyond the bound, hot codes (from ``stats``, see ``code_stats``) are salted in a
    shuffle join by ``record_key`` (columns that identify a record, else row numbers).
    ``graded``: :func:`graded_lists` or graded rows.
    """
    lk = code_lookup(cmap, graded, drop_codes, max_broadcast_rows)
    return split_weights(skew_safe_join(facts, lk, code, "code_raw", stats, "code_raw", "n_rows", salt_columns=record_key), weight, out)


def key_sizes(width: int = 6) -> dict[str, F.Column]:
    """Aggregates over ``match.nested_keys`` for :func:`allocate_by_key`, to be observed when the keys are
    materialized: rows and bytes of the keys of full width and of the prefixes."""
    words = lambda text: F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 8) * 8   # noqa: E731  strings take whole words
    size = F.aggregate("entries", words("key") + 112, lambda n, x: n + 32 + words(x["target"]))
    exact = F.col("L") == width
    return {"exact_rows": F.count_if(exact), "exact_bytes": F.sum(F.when(exact, size)),
            "prefix_rows": F.count_if((F.col("L") > 0) & ~exact), "prefix_bytes": F.sum(F.when((F.col("L") > 0) & ~exact, size))}


def allocate_by_key(facts: DataFrame, cmap: DataFrame, keys: DataFrame, own: DataFrame, code: str = "code", weight: str = "wt",
                    out: str = "wt_adj", drop_codes: Sequence[str] = DROP_CODES, lengths: Sequence[int] = PREFIX_LENGTHS,
                    width: int = 6, max_rows: int | None = None, stats: DataFrame | None = None,
                    record_key: Sequence[str] = (), clean_types: Sequence[str] = CLEAN_TYPES,
                    acceptable_max: int = ACCEPTABLE_MAX, coarse_max: int = COARSE_MAX) -> DataFrame:
    """:func:`allocate` for many codes: the entries that codes share are met by their key, after the code.

    ``keys``: ``match.nested_keys`` materialized with :func:`key_sizes`; ``own``: graded rows (:func:`graded_rows`)
    of the codes with overrides, few.  A prefix has many codes and up to one entry per target.  Nested in the
    lookup, those entries stand there once per code, and are written, shuffled and sorted with it;
    here the lookup holds a code's key, and the entries of the prefixes are broadcast to the
    records.  Where they are too large for that, they are nested in the lookup.  Full keys have few entries
    and as many rows as the dictionary: theirs are in the lookup.
    """
    limit = max_broadcast_rows(cmap) if max_rows is None else max_rows
    size = observed(keys)
    parts = {"exact": F.col("L") == width, "prefix": (F.col("L") > 0) & (F.col("L") < width)}
    rows = {k: int(size[f"{k}_rows"] or 0) for k in parts}
    bulk = {k: int(size[f"{k}_bytes"] or 0) for k in parts}
    n = F.size("entries").cast("long")
    types = F.when(F.col("L") == width, F.lit(EXACT)).otherwise(F.concat(F.lit("prefix_"), F.col("L").cast("string"), F.lit("d")))
    graded = keys.select("L", "key", "entries", n.alias("n_targets"), types.alias("match_type")).withColumn(
        "match_quality", _quality(clean_types, acceptable_max, coarse_max))
    listed = ["n_targets", "match_type", "match_quality", "entries"]
    exact = with_size(graded.where(parts["exact"]).select("key", *listed), rows["exact"], bulk["exact"])
    prefixes = with_size(keys.where(parts["prefix"]).select("L", "key"), rows["prefix"], rows["prefix"] * 64)
    shared = sized_broadcast(with_size(graded.where(parts["prefix"]).select(F.col("L").alias("__sl"), F.col("key").alias("__sk"), *[F.col(c).alias(f"__{c}") for c in listed]),
                                       rows["prefix"], bulk["prefix"]), limit)
    late = getattr(shared, "_codeloom_broadcast", False)

    def with_shared(d: DataFrame, key: F.Column) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in d.columns if c not in (*listed, "L", "key")]
        d = d.join(shared, (key == shared["__sk"]) & (d["L"] == shared["__sl"]), "left")
        return d.select(*kept, *[F.coalesce(c, f"__{c}").alias(c) for c in listed])

    keep = drop_codes_filter(cmap.where("keep"), drop_codes, "code_str").drop("keep")
    plain = longest_keys(keep, prefixes, exact, lengths, width)
    # a code of full width has its entries, so it must not meet a prefix as well; nor has a code with overrides
    lists = own.groupBy("code", *listed[:3]).agg(F.collect_list(F.struct("target", "multi_io")).alias("entries"))
    lists = F.broadcast(lists.select(F.col("code").alias("__oc"), *[F.col(c).alias(f"__{c}") for c in listed]))
    d = plain.join(lists, plain["code_str"] == lists["__oc"], "left")
    mine = F.col("__oc").isNotNull()
    lk = d.select(*keep.columns, F.when(~mine & (F.col("L") < width), F.col("L")).otherwise(F.lit(0)).alias("L"),
                  F.when(~mine & (F.col("L") < width), F.col("key")).alias("key"), *[F.when(mine, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in listed])
    if not late:   # a code without a shared key stands under its own text, so that a shuffle doesn't gather such codes
        lk = with_shared(lk, F.coalesce("key", "code_raw"))
    # written, it also keeps what its filters say of a code from being tested on each record
    lk = sized_broadcast(lk, limit, materialize_first=True)
    j = skew_safe_join(facts, lk, code, "code_raw", stats, "code_raw", "n_rows", salt_columns=record_key)
    return split_weights(with_shared(j, j["key"]) if late else j, weight, out, "entries")


def split_weights(j: DataFrame, weight: str = "wt", out: str = "wt_adj", entries: str = "matches") -> DataFrame:
    """Records that have found their row of ``code_lookup``, fanned out, with their share of the weight."""
    found = ["target", "multi_io", "match_type", "n_targets", "match_quality"]
    kept = [c for c in j.columns if c not in (*found, entries)]
    rows = fanned_out(j, entries, outer=True)
    return rows.select(*kept, *found, (F.col(weight) / F.col("n_targets")).alias(out))


def code_stats(facts: DataFrame, code: str = "code", weight: str = "wt", exact: str | None = None) -> DataFrame:
    """Records reduced to one row per raw code: ``(code_raw, n_rows, wt_sum)``.

    ``exact``: a decimal type (e.g. ``decimal(28,6)``) in which weights are
    summed, so that totals of non-integral weights don't depend on the order.

    A map-side-combined aggregate: a code holding a third of all records
    still ships one partial row per task.  It is both the distinct-code list
    the matcher needs and the input of ``allocate_totals_from_stats``, so the
    totals path reads the records once.
    """
    return facts.groupBy(F.col(code).cast("string").alias("code_raw")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(weight).cast(exact) if exact else F.col(weight)).alias("wt_sum"))


def allocate_totals_from_stats(stats: DataFrame, cmap: DataFrame, graded: DataFrame,
                               by: Sequence[str] = ("target", "match_quality"),
                               drop_codes: Sequence[str] = DROP_CODES,
                               max_broadcast_rows: int | None = None) -> DataFrame:
    """Totals from per-code stats (see ``allocate_totals``).

    Both sides are per-code tables (small), so the lookup is not
    materialized; Catalyst/AQE size the join.
    """
    lk = code_lookup(cmap, graded, drop_codes, max_broadcast_rows, materialize=False)
    j = fanned_out(stats.join(lk, "code_raw", "inner"), "matches", outer=True)
    keys = [*by, "n_targets"]
    return (j.groupBy(*keys)
            .agg(F.sum("n_rows").alias("n_rows"), F.sum("wt_sum").alias("wt_sum"))
            .withColumn("wt_adj", F.round(F.col("wt_sum") / F.col("n_targets"), 4)))


def allocate_totals(facts: DataFrame, cmap: DataFrame, graded: DataFrame, code: str = "code",
                    weight: str = "wt", by: Sequence[str] = ("target", "match_quality"),
                    drop_codes: Sequence[str] = DROP_CODES,
                    max_broadcast_rows: int | None = None, exact: str | None = None) -> DataFrame:
    """Allocated totals per ``by`` + ``n_targets``, without the row-level fan-out.

    Output: ``*by, n_targets, n_rows, wt_sum, wt_adj`` where ``n_rows`` counts
    allocated rows, ``wt_sum`` sums the weights of those rows and ``wt_adj =
    round(wt_sum / n_targets, 4)`` is the allocated mass.  Unmatched records
    form the group with NULL keys and NULL ``wt_adj``.  Records are first
    reduced to one row per raw code, so the join sees only distinct codes;
    sums of integral weights are exact and divided once; with a decimal type
    ``exact`` so are others.
    """
    return allocate_totals_from_stats(code_stats(facts, code, weight, exact), cmap, graded, by,
                                      drop_codes, max_broadcast_rows)


def quality_sample(merged: DataFrame, tiers: Sequence[str] | None = ("clean", "acceptable"),
                   single_target_only: bool = False) -> DataFrame:
    """Restrict allocated rows to chosen quality tiers and/or ``n_targets == 1``."""
    d = merged
    if tiers is not None:
        d = d.where(F.col("match_quality").isin(list(tiers)))
    if single_target_only:
        d = d.where(F.col("n_targets") == 1)
    return d
