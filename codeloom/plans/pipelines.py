"""End-to-end compositions of the operators over the fixture inputs.

``PersonPipeline`` (one-sided: weighted records -> targets) and
``TariffPipeline`` (two-sided: dictionary <-> trade codes) build their
intermediate DataFrames lazily; nothing is computed until an action, except
the concordance checkpoint + size check that guards the broadcast at
allocation time.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.operators import allocate as al
from codeloom.operators import codes as cd
from codeloom.operators import dictionary as dc
from codeloom.operators import match as mt
from codeloom.operators.broadcast import concurrently, known_rows, materialize, with_row_bound
from codeloom.sources import fixtures as fx
from codeloom.sources import sinks
from codeloom.sources.tables import spread


@dataclass
class PersonPipeline:
    spark: SparkSession
    sf_dir: str
    drop_codes: tuple[str, ...] = mt.DROP_CODES
    lengths: tuple[int, ...] = mt.PREFIX_LENGTHS
    compact: bool = False

    @cached_property
    def raw_facts(self) -> DataFrame:
        return fx.src_codes(self.spark, self.sf_dir)

    @cached_property
    def facts(self) -> DataFrame:
        """Records with ``code_str, code_type, code_prefix, code_6d``; not-employed removed."""
        return cd.prepare_codes(self.raw_facts, "code", "code_str")

    @cached_property
    def dictionary(self) -> DataFrame:
        """Normalized dictionary, materialized: small, read by several tiers, and
        its exact row count bounds every broadcast derived from it."""
        return materialize(dc.normalize_dictionary(spread(fx.dict_raw(self.spark, self.sf_dir))), "dictionary")

    @cached_property
    def keys(self) -> DataFrame:
        """The dictionary's cascade keys with their targets nested, materialized: the one table that
        matching joins.  Range blocks instead of expanded ranges with ``compact``."""
        raw = spread(fx.dict_raw(self.spark, self.sf_dir))
        return materialize(mt.nested_keys(dc.compact_dictionary(raw) if self.compact else dc.normalize_dictionary(raw, distinct=False), self.lengths), "keys",
                           None if self.compact else al.key_sizes())

    @cached_property
    def code_stats(self) -> DataFrame:
        """One scan of the records: per raw code, row count and weight sum (materialized); the write
        also observes the records without a class (R8)."""
        return materialize(al.code_stats(self.raw_facts, "code", "wt"), "code_stats", {"n_unclassified": cd.unclassified_rows()})

    def prepare(self, *names: str) -> None:
        """Make the small tables that matching needs as concurrent jobs; each is lazy by itself."""
        jobs = {n: lambda n=n: getattr(self, n) for n in names or ("code_stats", "dictionary") if n not in self.__dict__}
        concurrently(**jobs)

    @cached_property
    def code_map(self) -> DataFrame:
        """Distinct raw codes decoded once (trim, class columns, keep flag)."""
        return with_row_bound(cd.code_map(self.code_stats, "code_raw", "code_str",
                                          already_distinct=True),
                              known_rows(self.code_stats))

    @cached_property
    def codes(self) -> DataFrame:
        """Distinct kept codes with class columns (from the code map)."""
        return cd.codes_from_map(self.code_map, "code_str")

    @cached_property
    def overrides(self) -> DataFrame:
        return mt.override_table(self.spark)

    @cached_property
    def matches(self) -> DataFrame:
        """All tiers before dedupe (cascade + present overrides)."""
        self.prepare()
        return mt.person_matches(self.codes, self.dictionary, self.overrides, self.lengths)

    @cached_property
    def lists(self) -> DataFrame:
        """One row per matched code: fan-out and the array of its graded matches."""
        self.prepare("code_stats", "keys")
        return al.graded_lists(self.codes, self.keys, self.overrides, self.drop_codes, self.lengths, blocks=self.compact)

    @cached_property
    def graded(self) -> DataFrame:
        """Best row per (code, target) with fan-out and grade."""
        return al.graded_rows(self.lists)

    @cached_property
    def matched_codes(self) -> DataFrame:
        """Distinct codes of the concordance, without the concordance."""
        self.prepare()
        return mt.matched_codes(self.codes, self.dictionary, self.overrides, self.drop_codes, self.lengths)

    @cached_property
    def concordance(self) -> DataFrame:
        """``(code, target, multi_io, match_type)``, unique per (code, target)."""
        return self.graded.select("code", "target", "multi_io", "match_type")

    def merged(self) -> DataFrame:
        key = ("l_orderkey", "l_linenumber")
        self.prepare("code_stats", "keys")
        if self.compact:
            return al.allocate(spread(self.raw_facts), self.code_map, self.lists, "code", "wt", "wt_adj",
                               self.drop_codes, stats=self.code_stats, record_key=key)
        named = self.codes.join(F.broadcast(self.overrides.select("code")), "code", "left_semi")
        own = al.graded_rows(al.graded_lists(named, self.keys, self.overrides, self.drop_codes, self.lengths))
        return al.allocate_by_key(spread(self.raw_facts), self.code_map, self.keys, own, "code", "wt", "wt_adj",
                                  self.drop_codes, self.lengths, stats=self.code_stats, record_key=key)

    def merged_by_buckets(self, buckets: int = 16) -> DataFrame:
        """E9/G10 over co-located tables: records and lookup are written once, bucketed by code, and merged
        without a shuffle (for repeated merges beyond the broadcast bound)."""
        lookup = al.code_lookup(self.code_map, self.lists, self.drop_codes, materialize=False)
        names = sinks.write_bucketed_pair(self.raw_facts, lookup, "code", "code_raw", self.code_stats, ("l_orderkey", "l_linenumber"), buckets)
        return al.split_weights(sinks.read_bucketed_pair(self.spark, *names, "code", "code_raw"))

    def totals(self, graded: DataFrame | None = None) -> DataFrame:
        return al.allocate_totals_from_stats(self.code_stats, self.code_map,
                                             self.lists if graded is None else graded,
                                             ("target", "match_quality"), self.drop_codes)


@dataclass
class TariffPipeline:
    spark: SparkSession
    sf_dir: str
    drop_prefixes: tuple[str, ...] = fx.TRADE_DROP_PREFIXES
    prefix_overrides: tuple[str, ...] = fx.TRADE_PREFIX_OVERRIDES
    overrides_both_sides: bool = False
    shared_dictionary: DataFrame | None = None

    @cached_property
    def dictionary(self) -> DataFrame:
        """Normalized dictionary, materialized (or passed in by another pipeline over the same cells)."""
        if self.shared_dictionary is not None:
            return self.shared_dictionary
        return materialize(dc.normalize_dictionary(spread(fx.dict_raw(self.spark, self.sf_dir))), "dictionary")

    @cached_property
    def code_counts(self) -> DataFrame:
        """Trade rows per (naics, ambiguous): one pass over the trade table, materialized."""
        return materialize(mt.trade_code_counts(self.trade_rows), "trade_code_counts")

    def prepare(self) -> None:
        """Make the dictionary and the per-code trade counts as concurrent jobs; each is lazy by itself."""
        jobs = {n: lambda n=n: getattr(self, n) for n in ("code_counts", "dictionary") if n not in self.__dict__}
        concurrently(**jobs)

    @cached_property
    def exact_codes(self) -> DataFrame:
        """Distinct unambiguous trade codes (bounded by the materialized counts)."""
        return with_row_bound(self.code_counts.where(~F.col("naics_ambiguous")).select("naics"),
                              known_rows(self.code_counts))

    @cached_property
    def key_stats(self) -> DataFrame:
        """Trade rows per (tier, key) probe: finds hot keys if the join cannot broadcast."""
        return mt.trade_key_stats(self.code_counts, self.drop_prefixes, self.prefix_overrides,
                                  self.overrides_both_sides)

    @cached_property
    def trade(self) -> DataFrame:
        return cd.normalize_tariff(fx.trade_raw(self.spark, self.sf_dir))

    @cached_property
    def trade_rows(self) -> DataFrame:
        """Normalized trade rows *without* the table-wide distinct: the
        concordance keeps one row per (target, tariff code), so duplicate
        trade rows cannot change it, and the large side skips a full shuffle."""
        return cd.normalize_tariff(fx.trade_raw(self.spark, self.sf_dir), distinct=False)

    @cached_property
    def concordance(self) -> DataFrame:
        self.prepare()
        return mt.two_sided_concordance(self.dictionary, self.trade_rows, self.drop_prefixes,
                                        self.prefix_overrides, self.overrides_both_sides,
                                        self.exact_codes, self.key_stats)

    @cached_property
    def fanout(self) -> DataFrame:
        """Targets per tariff code, with one shuffle above the join."""
        self.prepare()
        matches = mt.tariff_matches(self.dictionary, self.trade_rows, self.drop_prefixes, self.prefix_overrides, self.overrides_both_sides,
                                    exact_codes=self.exact_codes, key_stats=self.key_stats, reduced=True)
        return mt.target_fanout(matches)

    @cached_property
    def matched_targets(self) -> DataFrame:
        """Distinct targets of the concordance, from per-key counts alone."""
        self.prepare()
        return mt.matched_targets(self.dictionary, self.exact_codes, self.key_stats, self.prefix_overrides)
