"""Column functions against plain-Python statements of the same rules, on random inputs."""

import random
import re

import pytest

from codeloom.functions.classify import CODE_CLASS_RULES, classify
from codeloom.functions.ranges import expand_ranges
from codeloom.functions.text import WHITE_SPACE_CHARS, pad_right_digits, strip_code_suffix, trim_ws

INT_MAX = 2**31 - 1


def py_expand(tok: str) -> list[str]:
    if re.fullmatch(r"[0-9]+-[0-9]+", tok):
        base, suffix = tok.split("-")
        keep = len(base) - len(suffix)
        if keep >= 0:
            start, end = int(base), int(base[:keep] + suffix)
            if start <= INT_MAX and end <= INT_MAX and end >= start:
                return [str(x) for x in range(start, end + 1)]
    return [tok]


def py_class(code: str) -> str:
    for pat, name in CODE_CLASS_RULES:
        if re.search(pat, code):
            return name
    return "other"


def py_pad(x: str) -> str:
    return x.ljust(6, "0") if re.fullmatch(r"[0-9]+", x) and len(x) < 6 else x


def _tokens(seed: int, n: int = 300) -> list[str]:
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a = "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(1, 7)))
        b = "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(1, 5)))
        kind = rnd.randrange(5)
        out.append(f"{a}-{b}" if kind < 3 else a if kind == 3 else f"{a}A{b}")
    return out


def test_expand_ranges_matches_python(spark):
    toks = sorted(set(_tokens(3)))
    df = spark.createDataFrame([(t,) for t in toks], "tok string")
    got: dict[str, list[str]] = {}
    for r in expand_ranges(df, "tok", "out").collect():
        got.setdefault(r.tok, []).append(r.out)
    assert {k: sorted(v) for k, v in got.items()} == {t: sorted(py_expand(t)) for t in toks}


def test_code_functions_match_python(spark):
    rnd = random.Random(5)
    ws = list(WHITE_SPACE_CHARS)
    codes = []
    for _ in range(400):
        core = "".join(rnd.choice("0123456789ZMPSX") for _ in range(rnd.randrange(1, 8)))
        pad_l = "".join(rnd.choice(ws) for _ in range(rnd.randrange(0, 3)))
        pad_r = "".join(rnd.choice(ws) for _ in range(rnd.randrange(0, 3)))
        codes.append(pad_l + core + pad_r)
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    out = df.select("c", trim_ws("c").alias("t")).select(
        "c", "t", classify("t").alias("k"), strip_code_suffix("t").alias("p"),
        pad_right_digits("t").alias("r")).collect()
    for r in out:
        t = r.c.strip(WHITE_SPACE_CHARS)
        assert r.t == t
        assert r.k == py_class(t)
        assert r.p == re.sub(r"[A-Z][0-9]*$", "", t, count=1)
        assert r.r == py_pad(t)


def py_trim(x: str) -> str:
    return x.strip(WHITE_SPACE_CHARS)


def py_normalize(cells):
    """E2 in plain Python: filter, per-cell star flag, split, trim, expand, pad, distinct."""
    out = set()
    for target, raw in cells:
        if target is None or raw is None or py_trim(raw) == "n.a.":
            continue
        flag = "*" in raw
        for tok in re.split(r",[" + re.escape(WHITE_SPACE_CHARS) + r"]*", raw.replace("*", "")):
            for x in py_expand(py_trim(tok)):
                out.add((target, py_pad(x), flag))
    return out


def test_normalize_dictionary_matches_python(spark):
    from codeloom.operators.dictionary import normalize_dictionary

    rnd = random.Random(11)
    cells = []
    for i in range(200):
        toks = []
        for _ in range(rnd.randrange(1, 4)):
            a = "".join(rnd.choice("0123456789") for _ in range(rnd.randrange(2, 6)))
            kind = rnd.randrange(5)
            toks.append(a if kind < 2 else f"{a}-{rnd.randrange(0, 10)}" if kind < 4 else a[:3] + "A0")
        raw = rnd.choice(["", " ", " "]) + ", ".join(toks) + rnd.choice(["", ",", "*", " *"])
        cells.append((rnd.choice(["T1", "T2", "T3", None]), rnd.choice([raw, raw, raw, " n.a.", None])))
    df = spark.createDataFrame(cells, "target string, raw string")
    got = {(r.target, r.key6, r.multi_io) for r in normalize_dictionary(df).collect()}
    assert got == py_normalize(cells)


def py_concordance(codes, dictionary, overrides, drop):
    """The person concordance in plain Python, tier by tier, then dedupe and grade."""
    ranks = {"exact_6d": 1, "manual_govt": 1, "prefix_5d": 2, "prefix_4d": 3, "prefix_3d": 4, "prefix_2d": 5}
    rows = []
    for code in codes:
        numeric = bool(re.fullmatch(r"[0-9]+", code))
        prefix = re.sub(r"[A-Z][0-9]*$", "", code, count=1)
        hits = []
        if numeric:
            hits = [(t, m, "exact_6d") for t, k, m in dictionary if k == py_pad(code)]
        for n in (5, 4, 3, 2):
            if hits:
                break
            if len(prefix[:n]) == n:
                hits = [(t, m, f"prefix_{n}d") for t, k, m in dictionary if k[:n] == prefix[:n]]
        rows += [(code, t, m, mt_) for t, m, mt_ in hits]
    rows += [(c, t, False, "manual_govt") for c, t in overrides if c in codes]
    best = {}
    for code, t, m, mt_ in rows:
        if code in drop:
            continue
        key = (ranks[mt_], mt_, m)
        if (code, t) not in best or key < best[(code, t)][0]:
            best[(code, t)] = (key, m, mt_)
    fan = {}
    for code, t in best:
        fan[code] = fan.get(code, 0) + 1
    out = set()
    for (code, t), (_, m, mt_) in best.items():
        n = fan[code]
        q = ("clean" if mt_ in ("exact_6d", "manual_govt") else "acceptable" if n <= 4
             else "coarse" if n <= 15 else "unusable")
        out.add((code, t, m, mt_, n, q))
    return out


@pytest.mark.parametrize("seed", [31, 32, 33])
def test_person_concordance_matches_python(spark, seed):
    from codeloom.operators import allocate as al
    from codeloom.operators import codes as cd
    from codeloom.operators import match as mt

    rnd = random.Random(seed)
    dictionary = {(f"T{rnd.randrange(20)}", "".join(rnd.choice("0123") for _ in range(6)),
                   rnd.random() < 0.3) for _ in range(120)}
    codes = set()
    for _ in range(150):
        core = "".join(rnd.choice("0123") for _ in range(rnd.randrange(2, 7)))
        codes.add(core + rnd.choice(["", "", "Z", "M1", "P2", "S", "MP", "x"]))
    codes |= {"92MP", "92113"}
    drop = {"3MS"} | {sorted(codes)[0]}
    overrides = [("92MP", "928110"), ("92113", "928120"), ("923", "928110")]
    dict_df = spark.createDataFrame(sorted(dictionary), "target string, key6 string, multi_io boolean")
    facts = spark.createDataFrame([(c,) for c in sorted(codes)], "code string")
    codes_df = cd.codes_from_map(cd.code_map(facts, "code", "code_str"))
    ov = spark.createDataFrame([(c, t, False, "manual_govt") for c, t in overrides], mt.MATCH_SCHEMA)
    graded = al.best_graded(cd.drop_codes_filter(mt.person_matches(codes_df, dict_df, ov), sorted(drop)))
    got = {(r.code, r.target, r.multi_io, r.match_type, r.n_targets, r.match_quality)
           for r in graded.collect()}
    assert got == py_concordance(codes, dictionary, overrides, drop)


def py_two_sided(dictionary, trade, drop, fams):
    """The two-sided concordance in plain Python: three tiers, then best per (target, hts10)."""
    rows = []
    unamb = [(h, n) for h, n, a in trade if not a]
    exact_keys = {n for _, n in unamb}
    for t, k, m in dictionary:
        rows += [(t, k, h, "exact_6d", m) for h, n in unamb if n == k]
        fam = next((o for o in fams if k.startswith(o)), k[:5])
        for h, n, a in trade:
            if a and not any(n.startswith(p) for p in drop) and n.rstrip("X") == fam:
                rows.append((t, k, h, "ambiguous_prefix", m))
        if k not in exact_keys:
            rows += [(t, k, h, "fallback_5d", m) for h, n in unamb if n[:5] == k[:5]]
    rank = {"exact_6d": 1, "ambiguous_prefix": 2, "fallback_5d": 3}
    best = {}
    for t, k, h, mt_, m in rows:
        key = (rank[mt_], k, m, mt_)
        if (t, h) not in best or key < best[(t, h)]:
            best[(t, h)] = key
    return {(t, k, h, mt_, m) for (t, h), (_, k, m, mt_) in best.items()}


@pytest.mark.parametrize("seed", [41, 42])
def test_two_sided_matches_python(spark, seed):
    from codeloom.operators import match as mt

    rnd = random.Random(seed)
    dictionary = {(f"T{rnd.randrange(8)}", "".join(rnd.choice("0123") for _ in range(6)),
                   rnd.random() < 0.3) for _ in range(60)}
    trade = set()
    for i in range(200):
        base = "".join(rnd.choice("0123") for _ in range(6))
        kind = rnd.randrange(4)
        code = base if kind < 2 else base[:rnd.randrange(3, 6)] + "X" * rnd.randrange(1, 4)
        trade.add((f"{rnd.randrange(60):010d}", code, "X" in code))
    d = spark.createDataFrame(sorted(dictionary), "target string, key6 string, multi_io boolean")
    t = spark.createDataFrame(sorted(trade), "hts10 string, naics string, naics_ambiguous boolean")
    got = {tuple(r) for r in mt.two_sided_concordance(d, t, ["000"], ["001"]).select(
        "target", "key6", "hts10", "match_type", "multi_io").collect()}
    assert got == py_two_sided(dictionary, trade, ["000"], ["001"])
