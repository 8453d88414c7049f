"""Code matching: exact, longest prefix, overrides, wildcards, fallback, dedupe.

Person-side pipeline (one-sided): facts carry a code; distinct codes are
matched to dictionary keys exactly (numeric, padded) or, failing that, by the
longest prefix of 5, 4, 3 or 2 characters that has any match, keeping every
tie at that length.  Manual overrides are added on top, dropped codes
removed, and the best row kept per (code, target).

Two-sided pipeline: tariff rows carry an industry code that may hold ``X``
wildcards; dictionary keys meet them exactly, through the stripped wildcard
prefix, or by a 5-character fallback for dictionary keys without an exact
match; the best row is kept per (target, tariff code).

Physical plan notes
-------------------
* Only *distinct* codes are matched; the facts come back in one broadcast
  join at allocation time.
* The cascade is equi-joins on ``(L, key)``: each code emits its exact key
  and its prefixes, a semi join against the distinct dictionary keys plus
  ``max(L)`` per code picks the winning length, and only the winning key is
  joined to the dictionary.  No nested-loop or ``startswith`` join, no
  repeated anti-join rounds, no shorter-prefix blow-up.
* Dedupe (``best_match``) is ``min(struct(rank, tie-breaks...))`` per key:
  an aggregate that combines on the map side, deterministic because the
  order is total (T4).  The person pipeline fuses it with fan-out and
  grading into one aggregate per code (``allocate.best_graded``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.functions.classify import rank_of
from codeloom.functions.text import strip_trailing
from codeloom.operators.broadcast import bound_from, like, sized_broadcast, skew_safe_join, with_row_bound
from codeloom.operators.codes import drop_codes_filter
from codeloom.operators.nested import fanned_out, first_per, nested

# Tiers of the person-code pipeline and their ranks
# (1 is best; a manual assignment ranks with an exact match).
EXACT = "exact_6d"
MANUAL = "manual_govt"
PERSON_RANKS = {"exact_6d": 1, "manual_govt": 1, "prefix_5d": 2,
                "prefix_4d": 3, "prefix_3d": 4, "prefix_2d": 5}
PREFIX_LENGTHS = (5, 4, 3, 2)

# Tiers of the two-sided (tariff) pipeline and their ranks.
AMBIGUOUS = "ambiguous_prefix"
FALLBACK = "fallback_5d"
TARIFF_RANKS = {"exact_6d": 1, "ambiguous_prefix": 2, "fallback_5d": 3}

# The survey pipeline's manual assignments (federal and
# state/local government codes) and the codes it drops as unassignable.
FEDERAL_CODES = ("92811P1", "92811P2", "92811P3", "92811P4", "92811P5",
                 "92811P6", "92811P7", "9281P", "9211MP", "92MP", "92M1", "92M2", "923")
STATE_CODES = ("92113", "92119")
FEDERAL_TARGET = "928110"
STATE_TARGET = "928120"
DROP_CODES = ("999920", "3MS", "4MS")

MATCH_SCHEMA = T.StructType([
    T.StructField("code", T.StringType(), True),
    T.StructField("target", T.StringType(), True),
    T.StructField("multi_io", T.BooleanType(), True),
    T.StructField("match_type", T.StringType(), True),
])


def _prefix_label(length_col) -> F.Column:
    return F.concat(F.lit("prefix_"), length_col.cast("string"), F.lit("d"))


# --------------------------------------------------------------------------
# person-side pipeline
# --------------------------------------------------------------------------
def match_exact(codes: DataFrame, dictionary: DataFrame, key: str = "key6") -> DataFrame:
    """G1: numeric codes whose padded form equals a dictionary key (one row per distinct code)."""
    c = codes.where((F.col("code_type") == "numeric") & F.col("code_6d").isNotNull())
    d = sized_broadcast(dictionary.select("target", F.col(key).alias("__k"), "multi_io"),
                        bound=bound_from(dictionary))
    return c.join(d, c.code_6d == d.__k, "inner").select(
        "code", "target", "multi_io", F.lit(EXACT).alias("match_type"))


def needs_prefix_pool(codes: DataFrame, exact: DataFrame) -> DataFrame:
    """Codes that are not numeric or have no exact match.

    ``type != numeric OR code NOT IN exact``; every exact code is numeric, so
    this is exactly the anti join on the code.
    """
    return codes.join(exact.select("code"), "code", "left_anti")


def prefix_tier(codes: DataFrame, dictionary: DataFrame, length: int,
                lengths: Sequence[int] = PREFIX_LENGTHS, key: str = "key6") -> DataFrame:
    """The matches of one prefix length, of codes without a longer match.

    The cascade's rows of that length; shorter lengths are not probed.
    """
    probed = [n for n in lengths if n >= length]
    return match_longest_prefix(codes, dictionary, probed, key=key).where(F.col("match_type") == f"prefix_{length}d")


def _code_key_sql(length: str, lengths: Sequence[int], width: int) -> str:
    """SQL for the probe key of a code at prefix length ``length`` (exact key at ``width``).

    Built as one expression string: a single call to the JVM instead of one
    per function node.
    """
    branches = [f"WHEN {length} = {width} THEN CASE WHEN code_type = 'numeric' THEN code_6d END"]
    for n in lengths:
        branches.append(f"WHEN {length} = {n} THEN CASE WHEN length(substring(code_prefix, 1, {n})) = {n} "
                        f"THEN substring(code_prefix, 1, {n}) END")
    return "CASE " + " ".join(branches) + " END"


def _code_keys(codes: DataFrame, lengths: Sequence[int], width: int) -> DataFrame:
    probes = ", ".join(str(n) for n in (width, *lengths))
    return (codes.selectExpr("code", "code_type", "code_prefix", "code_6d", f"explode(array({probes})) AS L")
            .selectExpr("*", f"{_code_key_sql('L', lengths, width)} AS key")
            .where("key IS NOT NULL"))


def _dictionary_keys(dictionary: DataFrame, lengths: Sequence[int], width: int,
                     key: str, reduced: bool = False) -> DataFrame:
    """``(target, multi_io, L, key)``; ``reduced``: one row per ``(target, L, key)``, the one a dedupe keeps."""
    # Keys shorter than n can never equal an n-character code prefix.
    entries = [f"named_struct('L', {width}, 'key', `{key}`)"] + [
        f"named_struct('L', {n}, 'key', CASE WHEN length(`{key}`) >= {n} THEN substring(`{key}`, 1, {n}) END)"
        for n in lengths]
    out = (dictionary.selectExpr("target", "multi_io", f"explode(array({', '.join(entries)})) AS __k")
           .selectExpr("target", "multi_io", "__k.L AS L", "__k.key AS key")
           .where("key IS NOT NULL"))
    return out.groupBy("target", "L", "key").agg(F.min("multi_io").alias("multi_io")) if reduced else out


#: Ends the key of a digit block, which no code holds.
OPEN = "~"


def _block_keys_sql(lengths: Sequence[int], width: int, key: str) -> list[str]:
    """Keys of a digit block (prefix ``key``, ``digits``), as of all the codes that it stands for.

    Under a prefix length that the block's own prefix reaches, it is that prefix.  Shorter blocks
    are open: ``p~`` meets any digits after p, ``p~D`` a code of D digits (and the zeros it is padded with).
    """
    own = f"concat(`{key}`, '{OPEN}', digits)"
    return [f"named_struct('L', {width}, 'key', {own})"] + [
        f"named_struct('L', {n}, 'key', CASE WHEN length(`{key}`) >= {n} THEN substring(`{key}`, 1, {n}) "
        f"WHEN digits >= {n} THEN concat(`{key}`, '{OPEN}') ELSE {own} END)" for n in lengths]


def _probe_keys_sql(length: str, lengths: Sequence[int], width: int) -> str:
    """SQL for all keys of a code at prefix length ``length``: its own and those of open blocks."""
    def starts(code: str, upto: str, tail: str) -> str:
        return f"transform(sequence(1, {upto}), k -> concat(substring({code}, 1, k), {tail}))"

    def padded(code: str, n: int, below: int) -> list[str]:
        return [f"CASE WHEN length({code}) = {n} AND substring({code}, {d + 1}) RLIKE '^0+$' "
                f"THEN {starts(code, str(d - 1), repr(OPEN + str(d)))} ELSE array() END" for d in range(2, below)]

    whole = ["array(code_6d)", starts("code_6d", "length(code_6d) - 1", f"'{OPEN}', length(code_6d)"), *padded("code_6d", width, width)]
    arms = [f"WHEN {length} = 0 THEN array('')", f"WHEN {length} = {width} THEN CASE WHEN code_type = 'numeric' THEN concat({', '.join(whole)}) END"]
    for n in lengths:
        p = f"substring(code_prefix, 1, {n})"
        more = [starts(p, str(n - 1), repr(OPEN)) if n > 1 else "array()", *padded(p, n, n)]
        arms.append(f"WHEN {length} = {n} THEN CASE WHEN length({p}) = {n} THEN concat(array({p}), "
                    f"CASE WHEN {p} RLIKE '^[0-9]+$' THEN concat({', '.join(more)}) ELSE array() END) END")
    return "CASE " + " ".join(arms) + " END"


def nested_keys(dictionary: DataFrame, lengths: Sequence[int] = PREFIX_LENGTHS, width: int = 6, key: str = "key6") -> DataFrame:
    """``(L, key, entries)``: one row per key of the cascade, with an entry ``(target, multi_io)`` for
    each target, the one that a dedupe per (code, target) keeps.

    One aggregate whose groups are bounded by the targets.  The row ``(0, '')`` has no entries and is
    what a code without a match finds.  A ``compact_dictionary`` may be given as well.
    """
    rows = _dictionary_keys(dictionary.where("digits IS NULL") if "digits" in dictionary.columns else dictionary, lengths, width, key)
    if "digits" in dictionary.columns:
        blocks = dictionary.where("digits IS NOT NULL").selectExpr("target", "multi_io", f"explode(array({', '.join(_block_keys_sql(lengths, width, key))})) AS __k")
        rows = rows.unionByName(blocks.selectExpr("target", "multi_io", "__k.L AS L", "__k.key AS key"))
    per = rows.groupBy("L", "key").agg(F.array_sort(F.collect_set(F.struct("target", "multi_io"))).alias("entries"))
    per = first_per(per, "entries", "target")
    none = dictionary.sparkSession.range(1).select(F.lit(0).alias("L"), F.lit("").alias("key"), F.array().cast(per.schema["entries"].dataType).alias("entries"))
    bound = bound_from(dictionary, 1 + len(lengths))
    return with_row_bound(per.unionByName(none), None if bound is None else bound + 1)


def matched_entries(codes: DataFrame, keys: DataFrame, lengths: Sequence[int] = PREFIX_LENGTHS, width: int = 6, blocks: bool = False) -> DataFrame:
    """``(code, L, entries)`` of every code: the entries (unique by target) of its longest matching
    length, none with ``L = 0`` if nothing matches.

    The cascade of :func:`match_longest_prefix` over :func:`nested_keys`: a semi join finds the
    winning length, a second join fetches one array.  ``blocks``: the keys are of a compact dictionary.
    """
    probes = ", ".join(str(n) for n in (0, width, *lengths))
    every = codes.selectExpr("code", "code_type", "code_prefix", "code_6d", f"explode(array({probes})) AS L")
    if blocks:
        each = lambda df: df.selectExpr("*", f"explode({_probe_keys_sql('L', lengths, width)}) AS key")
    else:
        own = _code_key_sql("L", lengths, width).replace("CASE ", "CASE WHEN L = 0 THEN '' ", 1)
        each = lambda df: df.selectExpr("*", f"{own} AS key")
    hit = each(every).where("key IS NOT NULL").join(sized_broadcast(with_row_bound(keys.select("L", "key"), bound_from(keys))), ["L", "key"], "left_semi")
    best = each(hit.groupBy("code", "code_type", "code_prefix", "code_6d").agg(F.max("L").alias("L")))
    found = best.join(sized_broadcast(keys), ["L", "key"]).select("code", "L", "entries")
    if not blocks:
        return found
    several = found.groupBy("code", "L").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("entries")))).alias("entries"))
    return first_per(several, "entries", "target")


def longest_keys(codes: DataFrame, prefixes: DataFrame, exact: DataFrame, lengths: Sequence[int] = PREFIX_LENGTHS, width: int = 6, code: str = "code_str") -> DataFrame:
    """``codes`` with the longest key that they have: ``(L, key)`` and the other columns of its row in
    ``exact``, or ``(L, key)`` among ``prefixes`` and nulls for those; ``L`` is 0 and ``key`` null without a match.

    The cascade of :func:`matched_entries` with a left join for each length instead of a group per
    code: a row stays a row, and where the keys are small no row moves.  ``prefixes`` holds distinct
    ``(L, key)``, ``exact`` has one row per ``key``.  A code without a key of some length has another
    tier there (-1), under its own text, so that a shuffle join doesn't gather such codes.
    """
    own = {n: F.when(F.length(F.substring("code_prefix", 1, n)) == n, F.substring("code_prefix", 1, n)) for n in lengths}
    own[width] = F.when(F.col("code_type") == "numeric", F.col("code_6d"))

    def found(d: DataFrame, keys: DataFrame, n: int) -> DataFrame:
        same = F.coalesce(own[n], F.col(code)) == keys[f"__k{n}"]
        return d.join(keys, same & (F.when(own[n].isNotNull(), F.lit(n)).otherwise(F.lit(-1)) == keys[f"__l{n}"]), "left")

    rest = [c for c in exact.columns if c != "key"]
    named = lambda k, n, *more: k.select(F.col("key").alias(f"__k{n}"), (F.col("L") if "L" in k.columns else F.lit(n)).alias(f"__l{n}"), *more)
    ex = sized_broadcast(like(exact, named(exact, width, *rest)))
    pre = lambda n: sized_broadcast(like(prefixes, named(prefixes, n)))
    d = codes
    for n in lengths:
        d = found(d, pre(n), n)
    d = found(d, ex, width)
    order = [width, *sorted(lengths, reverse=True)]
    longest = F.coalesce(*[F.col(f"__l{n}") for n in order], F.lit(0)).alias("L")
    return d.select(*codes.columns, longest, F.coalesce(*[F.col(f"__k{n}") for n in order]).alias("key"), *rest)


def match_longest_prefix(codes: DataFrame, dictionary: DataFrame,
                         lengths: Sequence[int] = PREFIX_LENGTHS, width: int = 6,
                         key: str = "key6", reduced: bool = False) -> DataFrame:
    """Exact first, then the longest prefix length with any match.

    Equal to running exact, 5, 4, 3, 2 as separate anti-join + join rounds.
    ``codes`` are distinct codes with class columns (``distinct_codes``);
    output is ``(code, target, multi_io, match_type)``.

    Plan: (1) each code emits at most ``1 + len(lengths)`` keys ``(L, key)``;
    (2) a broadcast semi join against the *distinct* dictionary keys keeps
    the keys that match anything, and ``max(L)`` per code picks the winning
    length (a map-side-combined hash aggregate); (3) only that key is joined to
    the dictionary.  Shorter-prefix matches of a code are never produced, so
    the work is linear in codes plus output, however broad a 2-character
    prefix is.  With ``reduced`` the dictionary comes down to one row per
    (target, L, key) first: the rows that a dedupe per (code, target) keeps,
    so a code has at most as many as there are targets.
    """
    if any(n >= width for n in lengths):
        raise ValueError("prefix lengths must be shorter than the key")
    ck = _code_keys(codes, lengths, width)
    dk = _dictionary_keys(dictionary, lengths, width, key, reduced)
    bound = bound_from(dictionary, 1 + len(lengths))
    hit = ck.join(sized_broadcast(dk.select("L", "key").distinct(), bound=bound), ["L", "key"], "left_semi")
    # max(L) per code is a hash aggregate on an int; the key is a function of
    # (code, L), so it is rebuilt instead of carried through the aggregate.
    best = (hit.groupBy("code", "code_type", "code_prefix", "code_6d").agg(F.max("L").alias("L"))
            .selectExpr("code", "L", f"{_code_key_sql('L', lengths, width)} AS key"))
    m = best.join(sized_broadcast(dk, bound=bound), ["L", "key"], "inner")
    return m.select(
        "code", "target", "multi_io",
        F.when(F.col("L") == width, F.lit(EXACT)).otherwise(_prefix_label(F.col("L"))).alias("match_type"))


def override_table(spark: SparkSession,
                   groups: Sequence[tuple[Sequence[str], str]] = ((FEDERAL_CODES, FEDERAL_TARGET),
                                                                  (STATE_CODES, STATE_TARGET)),
                   match_type: str = MANUAL, multi_io: bool = False) -> DataFrame:
    """A4: literal (code, target) assignments, scalars recycled over the rows."""
    rows = [(c, tgt, multi_io, match_type) for codes, tgt in groups for c in codes]
    return with_row_bound(spark.createDataFrame(rows, MATCH_SCHEMA), len(rows))


def overrides_present(overrides: DataFrame, codes: DataFrame) -> DataFrame:
    """Override rows whose code occurs in the data (semi join)."""
    return overrides.join(codes.select("code"), "code", "left_semi")


def apply_overrides(matches: DataFrame, overrides: DataFrame, codes: DataFrame) -> DataFrame:
    """Add (not replace) the present overrides to the matches (K1 union by name)."""
    return matches.unionByName(overrides_present(overrides, codes), allowMissingColumns=True)


def best_match(matches: DataFrame, keys: Sequence[str], ranks: dict[str, int],
               tie_break: Sequence[str]) -> DataFrame:
    """The best row per key, by rank then the tie-break columns.

    The remaining columns follow as final tie-breaks, so the pick is a total
    order and does not depend on partitioning or input order (T4).
    """
    rest = [c for c in matches.columns if c not in keys and c not in tie_break]
    order = ["__rank", *tie_break, *rest]
    ranked = matches.withColumn("__rank", rank_of("match_type", ranks))
    best = ranked.groupBy(*keys).agg(F.min(F.struct(*order)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in matches.columns if c not in keys])


def person_matches(codes: DataFrame, dictionary: DataFrame, overrides: DataFrame | None,
                   lengths: Sequence[int] = PREFIX_LENGTHS, reduced: bool = False) -> DataFrame:
    """K1: all tiers before dedupe: cascade result plus present overrides.

    ``reduced`` leaves out the ties that the dedupe drops anyway.
    """
    m = match_longest_prefix(codes, dictionary, lengths, reduced=reduced)
    return apply_overrides(m, overrides, codes) if overrides is not None else m


def person_concordance(codes: DataFrame, dictionary: DataFrame, overrides: DataFrame | None,
                       drop_codes: Sequence[str] = DROP_CODES,
                       lengths: Sequence[int] = PREFIX_LENGTHS) -> DataFrame:
    """Concordance ``(code, target, multi_io, match_type)``, unique per (code, target)."""
    m = drop_codes_filter(person_matches(codes, dictionary, overrides, lengths, reduced=True), drop_codes)
    return best_match(m, ["code", "target"], PERSON_RANKS, ["match_type", "multi_io"])


def matched_codes(codes: DataFrame, dictionary: DataFrame, overrides: DataFrame | None,
                  drop_codes: Sequence[str] = DROP_CODES, lengths: Sequence[int] = PREFIX_LENGTHS,
                  width: int = 6, key: str = "key6") -> DataFrame:
    """Distinct codes that the concordance has: any key in the dictionary, or a present override."""
    keys = _dictionary_keys(dictionary, lengths, width, key).select("L", "key").distinct()
    hit = _code_keys(codes, lengths, width).join(
        sized_broadcast(keys, bound=bound_from(dictionary, 1 + len(lengths))), ["L", "key"], "left_semi").select("code")
    if overrides is not None:
        hit = hit.unionByName(overrides_present(overrides, codes).select("code"))
    return drop_codes_filter(hit, drop_codes).distinct()


# --------------------------------------------------------------------------
# two-sided (tariff) pipeline
# --------------------------------------------------------------------------
_TARIFF_COLS = ["target", "key6", "hts10", "match_type", "multi_io"]


def _tier_stats(key_stats: DataFrame | None, tier: str) -> DataFrame | None:
    return None if key_stats is None else key_stats.where(F.col("tier") == tier)


def _least_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of ``rows`` (target, key6, multi_io, *keys) per (target, *keys): the one a dedupe keeps."""
    least = rows.groupBy("target", *keys).agg(F.min(F.struct("key6", "multi_io")).alias("__least"))
    return least.select("target", "__least.key6", "__least.multi_io", *keys)


def _tier(trade: DataFrame, rows: DataFrame, fact_key: str, dictionary: DataFrame, key_stats: DataFrame | None,
          tier: str, ties: bool) -> DataFrame:
    """Trade rows meet the dictionary ``rows`` (target, key6, multi_io, __k) of a tier in two steps: the
    join finds the row of a key, its entries fan out above it.  Without ``ties`` a key has one entry
    for each target (the least key), so a trade row gets at most as many rows as there are targets."""
    rows = rows if ties else _least_rows(rows, ["__k"])
    small = sized_broadcast(nested(rows, ["__k"], bounded=not ties), bound=bound_from(dictionary))
    j = skew_safe_join(trade.select("hts10", F.col(fact_key).alias("__t")), small, "__t", "__k",
                       _tier_stats(key_stats, tier), "key")
    return fanned_out(j).select("target", "key6", "hts10", F.lit(tier).alias("match_type"), "multi_io")


def tariff_exact(dictionary: DataFrame, trade: DataFrame, key_stats: DataFrame | None = None, ties: bool = True) -> DataFrame:
    """Exact tier: dictionary key equals an unambiguous trade code."""
    rows = dictionary.select("target", "key6", "multi_io", F.col("key6").alias("__k"))
    return _tier(trade.where(~F.col("naics_ambiguous")), rows, "naics", dictionary, key_stats, EXACT, ties)


def _family_key(col, overrides: Sequence[str], default: F.Column) -> F.Column:
    """The override family a key starts with, else ``default``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for o in overrides:
        cond = c.startswith(o)
        expr = F.when(cond, F.lit(o)) if expr is None else expr.when(cond, F.lit(o))
    return default if expr is None else expr.otherwise(default)


def match_wildcards(trade: DataFrame, dictionary: DataFrame,
                    drop_prefixes: Sequence[str] = (), prefix_overrides: Sequence[str] = (),
                    overrides_both_sides: bool = False, wildcard: str = "X",
                    key_len: int = 5, key_stats: DataFrame | None = None, ties: bool = True) -> DataFrame:
    """Ambiguous trade codes matched through their stripped prefix.

    Dropped families are removed; the trailing wildcard run is stripped; the
    dictionary key is the first ``key_len`` characters, or the override
    family when a key starts with one.  As coded (D1) only the dictionary
    side is re-keyed; ``overrides_both_sides`` re-keys the trade side too.
    ``ties=False`` keeps one key per (target, tariff code), as the concordance does.
    """
    t = trade.where(F.col("naics_ambiguous"))
    for p in drop_prefixes:
        t = t.where(~F.col("naics").startswith(p))
    t = t.withColumn("__p", strip_trailing("naics", wildcard))
    if overrides_both_sides and prefix_overrides:
        t = t.withColumn("__p", _family_key("__p", prefix_overrides, F.col("__p")))
    d = dictionary.select("target", "key6", "multi_io", _family_key(
        "key6", prefix_overrides, F.substring("key6", 1, key_len)).alias("__p"))
    return _tier(t, d.withColumnRenamed("__p", "__k"), "__p", dictionary, key_stats, AMBIGUOUS, ties)


def exact_trade_codes(trade: DataFrame) -> DataFrame:
    """Distinct unambiguous trade codes ``(naics)``: a small, map-side-combined aggregate."""
    return trade.where(~F.col("naics_ambiguous")).select("naics").distinct()


def unmatched_dictionary(dictionary: DataFrame, trade: DataFrame,
                         exact_codes: DataFrame | None = None) -> DataFrame:
    """Dictionary rows with no exact match on (target, key6).

    A dictionary row has an exact match iff its key equals some unambiguous
    trade code, so the anti join runs against the *distinct* trade codes
    rather than the exact-match rows.
    """
    codes = (exact_codes if exact_codes is not None else exact_trade_codes(trade)) \
        .select(F.col("naics").alias("key6"))
    return dictionary.join(codes, "key6", "left_anti").select(*dictionary.columns)


def fallback_5d(dictionary: DataFrame, trade: DataFrame, key_len: int = 5,
                exact_codes: DataFrame | None = None, key_stats: DataFrame | None = None, ties: bool = True) -> DataFrame:
    """5-character fallback for dictionary rows without an exact match."""
    un = unmatched_dictionary(dictionary, trade, exact_codes).select(
        "target", "key6", "multi_io", F.substring("key6", 1, key_len).alias("__k"))
    t = trade.where(~F.col("naics_ambiguous")).withColumn("__p", F.substring("naics", 1, key_len))
    return _tier(t, un, "__p", dictionary, key_stats, FALLBACK, ties)


def tariff_tiers(dictionary: DataFrame, trade: DataFrame, drop_prefixes: Sequence[str] = (),
                 prefix_overrides: Sequence[str] = (), overrides_both_sides: bool = False,
                 exact_codes: DataFrame | None = None, key_stats: DataFrame | None = None, ties: bool = True) -> DataFrame:
    """K1: exact, wildcard and fallback tiers as three joins, union by name.

    Reference form of ``tariff_matches`` (same rows); kept for the per-tier
    queries and as a test oracle.
    """
    exact = tariff_exact(dictionary, trade, key_stats, ties)
    wild = match_wildcards(trade, dictionary, drop_prefixes, prefix_overrides, overrides_both_sides,
                           key_stats=key_stats, ties=ties)
    fb = fallback_5d(dictionary, trade, exact_codes=exact_codes, key_stats=key_stats, ties=ties)
    return exact.select(*_TARIFF_COLS).unionByName(wild).unionByName(fb)


def _trade_keys(drop_prefixes: Sequence[str], prefix_overrides: Sequence[str],
                overrides_both_sides: bool, wildcard: str, key_len: int) -> F.Column:
    """Array of ``(tier, key)`` probes of a trade row (NULL keys are dropped later)."""
    amb = F.col("naics_ambiguous")
    keep_amb = amb
    for p in drop_prefixes:
        keep_amb = keep_amb & ~F.col("naics").startswith(p)
    stripped = strip_trailing("naics", wildcard)
    if overrides_both_sides and prefix_overrides:
        stripped = _family_key(stripped, prefix_overrides, stripped)
    return F.array(
        F.struct(F.lit(EXACT).alias("tier"), F.when(~amb, F.col("naics")).alias("key")),
        F.struct(F.lit(FALLBACK).alias("tier"),
                 F.when(~amb, F.substring("naics", 1, key_len)).alias("key")),
        F.struct(F.lit(AMBIGUOUS).alias("tier"), F.when(keep_amb, stripped).alias("key")),
    )


def trade_code_counts(trade: DataFrame) -> DataFrame:
    """``(naics, naics_ambiguous, n_rows)``: one map-side-combined pass over the trade rows."""
    return trade.groupBy("naics", "naics_ambiguous").agg(F.count(F.lit(1)).alias("n_rows"))


def trade_key_stats(code_counts: DataFrame, drop_prefixes: Sequence[str] = (),
                    prefix_overrides: Sequence[str] = (), overrides_both_sides: bool = False,
                    wildcard: str = "X", key_len: int = 5) -> DataFrame:
    """Trade rows per ``(tier, key)`` probe, from per-code counts (small): finds hot keys."""
    probes = _trade_keys(drop_prefixes, prefix_overrides, overrides_both_sides, wildcard, key_len)
    return (code_counts.select("n_rows", F.explode(probes).alias("__k"))
            .select("__k.tier", "__k.key", "n_rows").where(F.col("key").isNotNull())
            .groupBy("tier", "key").agg(F.sum("n_rows").alias("n_rows")))


def _dictionary_probes(dictionary: DataFrame, exact_codes: DataFrame,
                       prefix_overrides: Sequence[str], key_len: int) -> DataFrame:
    """``(target, key6, multi_io, tier, key)``: the keys under which a trade row may meet a dictionary row."""
    has_exact = sized_broadcast(exact_codes.select(F.col("naics").alias("__n"), F.lit(True).alias("__has_exact")),
                                bound=bound_from(exact_codes))
    d = dictionary.join(has_exact, dictionary.key6 == has_exact.__n, "left").drop("__n")
    fam = _family_key("key6", prefix_overrides, F.substring("key6", 1, key_len))
    return d.select("target", "key6", "multi_io", F.explode(F.array(
        F.struct(F.lit(EXACT).alias("tier"), F.col("key6").alias("key")),
        F.struct(F.lit(AMBIGUOUS).alias("tier"), fam.alias("key")),
        F.struct(F.lit(FALLBACK).alias("tier"),
                 F.when(F.col("__has_exact").isNull(), F.substring("key6", 1, key_len)).alias("key")),
    )).alias("__k")).select("target", "key6", "multi_io", "__k.tier", "__k.key") \
        .where(F.col("key").isNotNull())


def matched_targets(dictionary: DataFrame, exact_codes: DataFrame, key_stats: DataFrame,
                    prefix_overrides: Sequence[str] = (), key_len: int = 5) -> DataFrame:
    """Distinct targets that the two-sided concordance has, from the trade rows' per-key counts alone."""
    probes = _dictionary_probes(dictionary, exact_codes, prefix_overrides, key_len)
    return probes.join(key_stats.select("tier", "key"), ["tier", "key"], "left_semi").select("target").distinct()


def tariff_matches(dictionary: DataFrame, trade: DataFrame, drop_prefixes: Sequence[str] = (),
                   prefix_overrides: Sequence[str] = (), overrides_both_sides: bool = False,
                   wildcard: str = "X", key_len: int = 5,
                   exact_codes: DataFrame | None = None,
                   key_stats: DataFrame | None = None, reduced: bool = False) -> DataFrame:
    """All three tiers in one scan of the trade table and one equi-join.

    Trade rows emit tagged keys: unambiguous rows ``(exact, naics)`` and
    ``(fallback, naics[:5])``; ambiguous, non-dropped rows
    ``(ambiguous, stripped prefix)``.  Dictionary rows emit ``(exact, key6)``,
    ``(ambiguous, family key)`` and, only when they have no exact match
    anywhere, ``(fallback, key6[:5])``.  Equi-join on ``(tier, key)``: the
    dictionary side is broadcast under its proven bound; beyond it, with
    per-key ``key_stats``, hot keys are salted (``skew_safe_join``).

    ``reduced``: the dictionary side comes down to one row per (target, tier,
    key), the one that the dedupe per (target, tariff code) keeps, so a trade
    row meets at most one row per target and tier.
    """
    ex = exact_codes if exact_codes is not None else exact_trade_codes(trade)
    dkeys = _dictionary_probes(dictionary, ex, prefix_overrides, key_len)
    if reduced:
        dkeys = _least_rows(dkeys, ["tier", "key"])
    probes = _trade_keys(drop_prefixes, prefix_overrides, overrides_both_sides, wildcard, key_len)
    tkeys = trade.select("hts10", F.explode(probes).alias("__k")) \
        .select("hts10", "__k.tier", "__k.key").where(F.col("key").isNotNull())

    small = sized_broadcast(nested(dkeys, ["tier", "key"], bounded=reduced), bound=bound_from(dictionary, 3))
    j = skew_safe_join(tkeys, small, ["tier", "key"], ["tier", "key"], key_stats,
                       ["tier", "key"], "n_rows")
    return fanned_out(j).select("target", "key6", "hts10", F.col("tier").alias("match_type"), "multi_io")


def target_fanout(matches: DataFrame, key: str = "hts10", out: str = "n_targets") -> DataFrame:
    """H2/R9 straight from matches: distinct targets per ``key``.

    The dedupe per (target, key) can't change the number of targets, so it is left out: one
    aggregate whose sets (bounded by the targets) are combined before its only shuffle, so that
    a hot key ships one set per task.
    """
    return matches.groupBy(key).agg(F.size(F.collect_set("target")).cast("long").alias(out))


def two_sided_concordance(dictionary: DataFrame, trade: DataFrame,
                          drop_prefixes: Sequence[str] = (), prefix_overrides: Sequence[str] = (),
                          overrides_both_sides: bool = False,
                          exact_codes: DataFrame | None = None,
                          key_stats: DataFrame | None = None) -> DataFrame:
    """Best tier per (target, hts10); ties by key then the multi flag (T4)."""
    tiers = tariff_matches(dictionary, trade, drop_prefixes, prefix_overrides, overrides_both_sides,
                           exact_codes=exact_codes, key_stats=key_stats, reduced=True)
    return best_match(tiers, ["target", "hts10"], TARIFF_RANKS, ["key6", "multi_io"])
