"""Queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from codeloom.llm import align, collocations, decontaminate, exact_dedup, language, near_dedup, packing, personal_data, quality, token_counts, toxicity, url_filter, warc
from codeloom.session import scratch_path
from codeloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        REGISTRY[name] = f
        return f
    return add


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_bpe_path() -> str:
    return tokenizer_path("word_bpe_49k.json")


@query("op1_benchmark_decontamination")
def op1(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, d, "documents", ["doc_id", "text"]),
                                       read_table(spark, d, "benchmark", ["item_id", "text"])).drop("spans")


ORACLE["op1_benchmark_decontamination"] = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
il AS (SELECT item_id, w, least(len(w), 13) AS l FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, l, array_to_string(w[i + 1:i + l], ' ') AS k FROM (SELECT *, unnest(range(len(w) - l + 1)) AS i FROM il)),
lens AS (SELECT DISTINCT l FROM win),
dl AS (SELECT doc_id, l, i, array_to_string(w[i + 1:i + l], ' ') AS k FROM (SELECT doc_id, w, l, unnest(range(len(w) - l + 1)) AS i FROM dw, lens WHERE len(w) >= l)),
hit AS (SELECT doc_id, item_id, i, dl.l AS l FROM dl JOIN win ON dl.k = win.k AND dl.l = win.l),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.s, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AND 20 * coalesce(pos.n, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op2_zip_warc")
def op2(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, d, "pages", ["page_id", "url", "html"]), path)
    return warc.read_archives(spark, path, payloads=False).drop("url")


ORACLE["op2_zip_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
b AS (SELECT page_id, h, array_to_string(list_transform(string_split(sha1(h), ''), lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), '') AS bits FROM p),
m AS (SELECT page_id, h, bits, max(page_id) OVER (PARTITION BY h) AS keep FROM b)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda j: CAST(substr(bits, CAST(i * 5 + j + 1 AS BIGINT), 1) AS BIGINT) * CAST(pow(2, 4 - j) AS BIGINT)))::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM m"""


@query("op3_exact_dedup")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.duplicates(read_table(spark, d, "documents", ["doc_id", "text"]))


ORACLE["op3_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)"""


@query("op4_near_dedup")
def op4(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.classes(read_table(spark, d, "documents", ["doc_id", "text"]))


@query("op5_personal_data")
def op5(spark: SparkSession, d: str) -> DataFrame:
    return personal_data.spans(read_table(spark, d, "documents", ["doc_id", "text"]))


@query("op6_best_fit_packing")
def op6(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, d, "documents", ["doc_id", "text"]), word_bpe_path())


@query("op7_token_counts")
def op7(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, d, "documents", ["doc_id", "text"]), tokenizer_path("piece_bpe_32k.model"))


@query("op8_language_id")
def op8(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text", "lang"])
    return language.predictions(docs, language.train(docs))


@query("op9_toxicity")
def op9(spark: SparkSession, d: str) -> DataFrame:
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return toxicity.scores(docs, toxicity.train(docs, read_table(spark, d, "labels", ["doc_id", "toxic"])))


@query("op10_url_filter")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.verdicts(read_table(spark, d, "pages", ["page_id", "url", "html"]), url_filter.RULES)


def _host(u: str) -> str:
    return f"CASE WHEN strpos({u}, '://') > 0 THEN translate(regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"


def _path(u: str) -> str:
    return f"CASE WHEN strpos({u}, '://') > 0 THEN regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"


def _node(u: str) -> str:
    query = f"CASE WHEN strpos({u}, '://') > 0 THEN regexp_extract(substr({u}, strpos({u}, '://') + 3), '^[^?#]*(\\?[^#]*)', 1) ELSE '' END"
    return f"CASE WHEN {_host(u)} <> '' THEN {_host(u)} || CASE WHEN {_path(u)} = '' THEN '/' ELSE {_path(u)} END || {query} END"


def _rule(host: str, path: str, what: str) -> str:
    """``what``: rule or verdict of the longest rule that fits."""
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r[1] + r[2]), r[0]))
    cases = " ".join(f"WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{h + p if what == 'rule' else v}'" for v, h, p in rules)
    return f"CASE {cases} END"


def _attribute(name: str) -> str:
    values = ('"([^"]*)"', "''([^'']*)''", "([^\\s\"''>]+)")
    return "coalesce(" + ", ".join(f"nullif(regexp_extract(tag, '(?i)\\s{name}\\s*=\\s*{v}', 1), '')" for v in values) + ")"


ORACLE["op10_url_filter"] = rf"""
WITH RECURSIVE tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?i)<(?:link|meta)\s[^>]*>')) AS tag FROM pages),
att AS (SELECT url, {_attribute('rel')} AS rel, {_attribute('href')} AS href, {_attribute('http-equiv')} AS equiv, {_attribute('content')} AS content FROM tags),
lk AS (SELECT url, trim(replace(coalesce(CASE WHEN regexp_matches(lower(rel), '(^|\s)canonical(\s|$)') THEN href END,
         CASE WHEN lower(equiv) = 'refresh' THEN nullif(regexp_extract(content, '(?i)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*[''"]?([^''"]*)', 1), '') END), '&amp;', '&')) AS link FROM att),
full_links AS (SELECT url, CASE WHEN regexp_matches(link, '(?i)^https?://') THEN link WHEN regexp_matches(link, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
         WHEN starts_with(link, '//') THEN 'http:' || link WHEN {_host('url')} = '' THEN NULL WHEN starts_with(link, '/') THEN 'http://' || {_host('url')} || link
         WHEN starts_with(link, '?') THEN 'http://' || {_host('url')} || {_path('url')} || link WHEN starts_with(link, '#') THEN NULL
         ELSE 'http://' || {_host('url')} || CASE WHEN regexp_replace({_path('url')}, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace({_path('url')}, '[^/]*$', '') END || link END AS target
       FROM lk WHERE link IS NOT NULL AND link <> ''),
edge AS (SELECT DISTINCT {_node('url')} AS a, {_node('target')} AS b FROM full_links),
both_ways AS (SELECT a, b FROM edge WHERE a <> b UNION SELECT b, a FROM edge WHERE a <> b),
reach AS (SELECT a AS n, a AS m FROM both_ways UNION SELECT n, b FROM reach JOIN both_ways ON m = a),
judged AS (SELECT n, {_rule(_host("('http://' || m)"), _path("('http://' || m)"), 'verdict')} AS v FROM reach),
blocked AS (SELECT n FROM judged GROUP BY n HAVING bool_or(v = 'block') AND NOT coalesce(bool_or(v = 'allow'), false)),
p AS (SELECT page_id, {_host('url')} AS host, {_path('url')} AS path, {_node('url')} AS node FROM pages)
SELECT page_id, host, path, {_rule('host', 'path', 'rule')} AS rule,
       coalesce({_rule('host', 'path', 'verdict')}, CASE WHEN n IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN blocked ON node = n"""


@query("op11_quality_ranking")
def op11(spark: SparkSession, d: str) -> DataFrame:
    docs = quality.described(read_table(spark, d, "documents", ["doc_id", "text"]))
    return quality.scores(docs, quality.train(docs, read_table(spark, d, "labels", ["doc_id", "quality"])))


@query("op12_collocations")
def op12(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(read_table(spark, d, "documents", ["text", "lang"]))


ORACLE["op12_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS s) WHERE len(w) >= s),
g AS (SELECT lang, s, array_to_string(w[i:i + s - 1], ' ') AS phrase, count(*) AS a FROM i GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE s = 1 GROUP BY lang),
c AS (SELECT lang, s, phrase, a, string_split(phrase, ' ') AS w FROM g WHERE s > 1 AND a >= 100),
inner_parts AS (SELECT lang, a, array_to_string(w[b:b + t - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, s - t + 2)) AS b FROM (SELECT *, unnest(range(2, s)) AS t FROM c))),
most AS (SELECT lang, phrase, max(a) AS longer FROM inner_parts GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN most USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cut AS (SELECT *, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, s)) AS k FROM kept)),
sc AS (SELECT cut.lang, cut.phrase, cut.a, k, fl.a AS l, fr.a AS r, n, CAST((CAST(1000 AS HUGEINT) * cut.a * n) // (CAST(fl.a AS HUGEINT) * fr.a) AS BIGINT) AS score
  FROM cut JOIN g fl ON fl.lang = cut.lang AND fl.phrase = x AND fl.s = k JOIN g fr ON fr.lang = cut.lang AND fr.phrase = y AND fr.s = cut.s - k JOIN n ON n.lang = cut.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM sc),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM t WHERE rank <= 2000"""


@query("op13_token_alignment")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return align.alignments(read_table(spark, d, "documents", ["doc_id", "text"]), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
