"""Operator 5: personal data by weak supervision, with DataFrame operations only.

Candidates are the matches of one pattern a kind.  The four base kinds (email, ip, card, phone)
are spans whenever their check passes.  Three more kinds (secret, local_phone, spelled_email)
are spans when the method says so:

* labelers vote on every candidate for (1), against (-1) or not at all (0): its form, a
  gazetteer of cue words and endings next to it, its context, and its variety of characters;
* expectation-maximisation over the counts of vote patterns estimates how each labeler votes on
  true and false spans of each kind (there are at most 7 * 3 ** 4 patterns, whatever the input);
* the posterior probabilities are soft labels for the final classifier, naive Bayes over
  features of the span and its neighbourhood, whose counts are made in Spark.

Patterns use possessive repetition and start at the first character of a run (or where the
last match ended), so that they take linear time; this finds the same leftmost matches as the plain
patterns.  Positions are code points, summed up from the pieces between matches.

Defined results: null text counts as empty; each row is judged by itself, repeated rows and
null identifiers too; an added span never overlaps a base span or a span of an earlier added
kind; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.operators.broadcast import materialize

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "local_phone", "spelled_email")
KINDS = (*BASE, *ADDED)
#: One pattern a kind, and a cheap one that a text must match before.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])[A-Za-z0-9_+/-]{16,}+",
    "local_phone": r"(?<![0-9+(.-])(?<!\+[0-9] )(?<!\+[0-9]{2} )(?<!\+[0-9]{3} )\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "spelled_email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
}
PREFILTERS = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
    "secret": r"[A-Za-z0-9_+/-]{16}",
    "local_phone": r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
    "spelled_email": r"(?i)[\[(]at[\])]",
}
#: Cue words before a span of the kind; endings for the kinds of addresses.
CUES = {
    "email": ("email", "mail", "e-mail", "mailto", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "telefon"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "apikey", "api_key", "bearer", "auth"),
    "local_phone": ("tel", "phone", "call", "mobile", "fax", "telefon"),
    "spelled_email": ("email", "mail", "e-mail", "mailto", "contact", "correo", "courriel"),
}
ENDINGS = ("com", "net", "org", "edu", "gov", "de", "fr", "es", "io", "eu", "uk", "info")
#: Words before a number or name that speak against personal data.
AGAINST = ("version", "section", "page", "chapter", "isbn", "issn", "doi", "commit", "revision", "build", "sha", "md5", "checksum")
LABELERS = ("form", "gazetteer", "context", "variety")
#: Characters of neighbourhood that the labelers see, and positions summed up at once.
NEAR, CHUNK = 32, 512
ROUNDS = 50


def _placed(d: DataFrame) -> DataFrame:
    """``places``, the (start, end) of each of ``matches``, from the pieces of text (``gaps``) between them.

    Lengths are summed up in chunks, then over the chunks, so that many matches stay cheap.
    """
    place = "array<struct<start:int,end:int>>"
    d = d.withColumn("lengths", F.zip_with(F.slice("gaps", F.lit(1), F.size("matches")), "matches", lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"))))
    d = d.withColumn("chunks", F.transform(F.sequence(F.lit(0), F.floor(F.size("lengths") / CHUNK).cast("int")), lambda c: F.slice("lengths", c * CHUNK + 1, F.lit(CHUNK))))
    d = d.withColumn("local", F.transform("chunks", lambda ch: F.aggregate(
        ch, F.struct(F.lit(0).alias("at"), F.array().cast(place).alias("out")),
        lambda a, x: F.struct((a["at"] + x["gap"] + x["len"]).alias("at"), F.concat(a["out"], F.array(F.struct(
            (a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["len"]).alias("end")))).alias("out")))))
    d = d.withColumn("before", F.aggregate("local", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                                           lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))["out"])
    moved = F.zip_with("local", "before", lambda x, o: F.transform(x["out"], lambda p: F.struct((p["start"] + o).alias("start"), (p["end"] + o).alias("end"))))
    return d.withColumn("places", F.flatten(moved)).drop("lengths", "chunks", "local", "before")


def _passes() -> Column:
    """Whether ``match`` passes the check of its ``kind``."""
    match, digits = F.col("match"), F.regexp_replace("match", "[^0-9]", "")
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return (F.when(F.col("kind") == "ip", F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.substring(part(p), 1, 3).cast("int") <= 255)))
            .when(F.col("kind") == "card", F.length(digits).between(12, 19) & F.call_function("luhn_check", digits))
            .when(F.col("kind") == "phone", F.length(digits).between(9, 15)).otherwise(True))


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row for every candidate that passes its kind's check, and one with a null kind for every document."""
    d = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    t = F.col("text")
    none = F.lit(None).cast("struct<kind:string,matches:array<string>,gaps:array<string>>")
    each = [F.when(t.rlike(PREFILTERS[k]), F.struct(F.lit(k).alias("kind"), F.regexp_extract_all(t, F.lit(PATTERNS[k]), F.lit(0)).alias("matches"), F.split(t, PATTERNS[k], -1).alias("gaps"))) for k in KINDS]
    d = d.select("doc_id", "row", F.explode(F.concat(F.array(none), F.filter(F.array(*each), lambda x: x.isNotNull()))).alias("f")).select("doc_id", "row", "f.*")
    d = _placed(d).withColumn("zipped", F.arrays_zip("places", "matches", "gaps", F.slice("gaps", F.lit(2), F.size("gaps")).alias("next")))
    d = d.select("doc_id", "row", "kind", F.explode_outer("zipped").alias("z"))
    d = d.select("doc_id", "row", "kind", F.col("z.places.start").alias("start"), F.col("z.places.end").alias("end"), F.col("z.matches").alias("match"),
                 F.right("z.gaps", F.lit(NEAR)).alias("before"), F.left("z.next", F.lit(NEAR)).alias("after"))
    return d.where(F.col("kind").isNull() | (F.col("match").isNotNull() & _passes()))


def _by_kind(values: dict[str, Column]) -> Column:
    return reduce(lambda c, kv: c.when(F.col("kind") == kv[0], kv[1]), values.items(), F.when(F.lit(False), None))


def _vote(good: Column, bad: Column | None = None) -> Column:
    out = F.when(good, 1)
    return (out.when(bad, -1) if bad is not None else out).otherwise(0)


def voted(found: DataFrame) -> DataFrame:
    """Candidates with the labelers' votes and the classifier's features."""
    m, before, after = F.col("match"), F.lower(F.col("before")), F.lower(F.col("after"))
    cue = F.regexp_extract(before, r"([a-z_][a-z0-9_-]*)[^a-z0-9]*$", 1)
    digits = F.regexp_replace(m, "[^0-9]", "")
    distinct = F.size(F.array_distinct(F.split(F.lower(m), "")))
    hexadecimal = m.rlike(r"^[0-9a-f]{32,}$|^[0-9A-F]{32,}$")
    ending = F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))
    form = _by_kind({
        "email": _vote(m.rlike(r"^[A-Za-z0-9][^@]{0,63}@[^@]+\.[A-Za-z]{2,24}$"), m.rlike(r"\.[0-9-]+$")),
        "ip": _vote(~m.rlike(r"(^|\.)0[0-9]"), m.rlike(r"^0|\.0{2,}")),
        "card": _vote(F.length(digits).between(15, 16), F.length(digits) < 13),
        "phone": _vote(m.rlike(r"[ ().-]"), ~m.rlike(r"[ ().-]")),
        "secret": _vote(hexadecimal | (m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]") & (F.length(m) >= 20)), m.rlike(r"^[A-Za-z]+[/_+-]|/[A-Za-z]+/")),
        "local_phone": _vote(m.rlike(r"^\([0-9]{3}\) [0-9]{3}-"), ~m.rlike("[-(]")),
        "spelled_email": _vote(m.rlike(r"(?i)[\[(]dot[\])]")),
    })
    listed = _by_kind({k: cue.isin(*CUES[k]) for k in KINDS})
    gazetteer = F.when(F.col("kind").isin("email", "spelled_email"), _vote(listed | ending.isin(*ENDINGS), ~ending.isin(*ENDINGS))).otherwise(_vote(listed))
    context = _vote(before.rlike(r"[=:<\"'(]\s*$"), cue.isin(*AGAINST) | before.rlike(r"[/\\]$"))
    variety = _vote(distinct >= F.when(F.col("kind") == "secret", 10).otherwise(5), distinct <= 3)
    features = {
        "length": F.least(F.floor(F.length(m) / 8), F.lit(8)).cast("string"),
        "digits": F.floor(F.length(digits) * 4 / F.length(m)).cast("string"),
        "distinct": F.least(F.floor(distinct / 4), F.lit(5)).cast("string"),
        "cue": F.when(listed, "listed").when(cue.isin(*AGAINST), "against").otherwise("none"),
        "before": F.regexp_replace(F.right(F.col("before"), F.lit(1)), r"[\p{L}\p{N}]", "a"),
        "after": F.regexp_replace(F.left(F.col("after"), F.lit(1)), r"[\p{L}\p{N}]", "a"),
    }
    return found.where("kind is not null").select("row", "kind", "start", "end", form.alias("form"), gazetteer.alias("gazetteer"), context.alias("context"), variety.alias("variety"),
                                                  *[F.concat(F.lit(n + "="), F.coalesce(c, F.lit(""))).alias("f_" + n) for n, c in features.items()])


def reliabilities(counts: dict[tuple, int]) -> dict[tuple, float]:
    """Posterior probability of a true span for each (kind, *votes), by expectation-maximisation.

    ``counts`` has the number of candidates of each pattern.  Labelers are independent given the
    truth; they are taken to be better than chance at the start.
    """
    out: dict[tuple, float] = {}
    for kind in sorted({p[0] for p in counts}):
        own = {p[1:]: n for p, n in counts.items() if p[0] == kind}
        post = {v: min(max(0.5 + 0.15 * sum(v), 0.05), 0.95) for v in own}
        for _ in range(ROUNDS):
            true = sum(n * post[v] for v, n in own.items()) + 1
            false = sum(n * (1 - post[v]) for v, n in own.items()) + 1
            like = {}
            for j in range(len(LABELERS)):
                for x in (-1, 0, 1):
                    t = sum(n * post[v] for v, n in own.items() if v[j] == x)
                    f = sum(n * (1 - post[v]) for v, n in own.items() if v[j] == x)
                    like[j, x] = ((t + 1 + (x > 0)) / (true + 4), (f + 1 + (x < 0)) / (false + 4))
            post = {v: 1 / (1 + math.exp(min(max(math.log(false / true) + sum(math.log(like[j, x][1] / like[j, x][0]) for j, x in enumerate(v)), -50), 50))) for v in own}
        out |= {(kind, *v): p for v, p in post.items()}
    return out


def judged(votes: DataFrame) -> DataFrame:
    """Candidates with ``posterior`` (of the votes) and ``probability`` (of the final classifier)."""
    spark = votes.sparkSession
    counts = {(r["kind"], *(r[x] for x in LABELERS)): r["n"] for r in votes.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [(*k, float(p)) for k, p in reliabilities(counts).items()]
    schema = "kind string, " + ", ".join(f"{x} int" for x in LABELERS) + ", posterior double"
    soft = votes.join(F.broadcast(spark.createDataFrame(rows, schema)), ["kind", *LABELERS])
    names = [c for c in votes.columns if c.startswith("f_")]
    totals = soft.groupBy("kind").agg(F.sum("posterior").alias("true"), F.sum(1 - F.col("posterior")).alias("false"))
    each = soft.select("kind", "posterior", F.explode(F.array(*names)).alias("feature")).groupBy("kind", "feature").agg(F.sum("posterior").alias("t"), F.sum(1 - F.col("posterior")).alias("f"))
    prior = {r["kind"]: (r["true"] + 1, r["false"] + 1) for r in totals.collect()}
    odds: dict[str, dict[str, float]] = {k: {} for k in prior}
    for r in each.collect():      # kinds times values of the features, a fixed number
        true, false = prior[r["kind"]]
        odds[r["kind"]][r["feature"]] = math.log((r["t"] + 0.5) / (true + 1)) - math.log((r["f"] + 0.5) / (false + 1))
    table = spark.createDataFrame([(k, math.log(prior[k][0] / prior[k][1]), v) for k, v in odds.items()], "kind string, prior double, odds map<string,double>")
    score = reduce(lambda a, b: a + b, [F.coalesce(F.try_element_at("odds", F.col(n)), F.lit(0.0)) for n in names], F.col("prior"))
    return soft.join(F.broadcast(table), "kind").withColumn("probability", 1 / (1 + F.exp(-score))).drop("prior", "odds")


def spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, counts of the base kinds, base_sha256, spans."""
    found = materialize(candidates(docs, text, doc_id), "pii_candidates")
    votes = materialize(voted(found), "pii_votes")
    accepted = judged(votes).where(F.col("kind").isin(*ADDED) & (F.col("probability") >= 0.5)).select("row", "kind", "start", "end")
    base = found.where(F.col("kind").isNull() | F.col("kind").isin(*BASE)).select("doc_id", "row", "kind", "start", "end")
    every = base.unionByName(accepted.withColumn("doc_id", F.lit(None).cast(base.schema["doc_id"].dataType)))
    order = _by_kind({k: F.lit(i) for i, k in enumerate(KINDS)})
    span = F.when(F.col("kind").isNotNull(), F.struct("start", order.alias("order"), "end", "kind"))
    doc = every.groupBy("row").agg(F.max(F.when(F.col("kind").isNull(), F.col("doc_id"))).alias("doc_id"), F.array_sort(F.collect_list(span)).alias("all"))
    base_only = F.filter("all", lambda s: s["order"] < len(BASE))
    doc = doc.withColumn("base", base_only)
    doc = doc.withColumn("all", F.when(F.size("all") == F.size("base"), F.col("all")).otherwise(F.concat("base", _without_overlaps())))

    def listing(column: str) -> Column:
        return F.array_join(F.transform(F.array_sort(column), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return doc.select("doc_id", *map(count, BASE), F.sha2(listing("base"), 256).alias("base_sha256"), listing("all").alias("spans"))


def _without_overlaps() -> Column:
    """Added spans of ``all`` that overlap no span of a kind before theirs."""
    return F.filter("all", lambda s: (s["order"] >= len(BASE)) & ~F.exists("all", lambda o: (o["order"] < s["order"]) & (o["start"] < s["end"]) & (s["start"] < o["end"])))
