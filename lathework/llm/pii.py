"""Personal data: fixed patterns, and spans that boosted trees add from high-recall candidates. DataFrame only.

Patterns give base spans. Generators propose overlapping candidates of every kind: e-mail and ip addresses also with
their separators disguised, phone-like digit groups, card-like digit runs and key-like strings. Some candidates are
settled by evidence that no feature holds: a standard separator and valid parts, a country prefix, a check digit, or a
keyword that the string is assigned to. A candidate's features are the rest of its format (digits, lengths, alphabet)
and its context (the characters at its ends, a keyword before it where that does not settle the kind). So the trees
learn what data of a kind look like from those that are surely so or surely not, and judge the ones that no rule
settles. They are fitted on the counts of feature combinations over all documents (a bounded table), thresholds per
kind are calibrated on a fold that the trees have not seen, and candidates above them that overlap no base span and
whose features some sure one of the kind has are added.

Positions come from splitting a text at its matches: lengths of pieces and matches add up to code point offsets.
Quantifiers are possessive and starts are guarded, so that long runs take linear time and no deep recursion.

Defined results: a null text is empty and has no spans. Every row has its own result. Columns named n_email, n_ip,
n_card, n_phone, base_spans or spans are replaced. An empty table gives an empty result and trains no trees.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.llm.boosting import BoostedTrees
from lathework.llm.common import fresh

LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
AT, DOT = r"(?:@| ?[\[(](?i:at)[\])] ?| (?i:at) )", r"(?:\.| ?[\[(](?i:dot)[\])] ?| (?i:dot) | ?\[\.\] ?)"
CANDIDATES = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+{AT}[A-Za-z0-9-]{{1,63}}+(?:{DOT}[A-Za-z0-9-]{{1,63}}+){{1,8}}+",
    "ip": rf"(?<![0-9])[0-9]{{1,3}}+(?:(?: \. |{DOT})[0-9]{{1,3}}+){{3}}(?![0-9])",
    "phone": r"(?<![0-9])\+?\(?[0-9][0-9() .-]{6,}[0-9]",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+",
}
MAYBE = {"email": r"@|[\[(](?:at|AT|At)[\])]| (?:at|AT|At) [A-Za-z0-9-]+ (?:dot|DOT|Dot) ", "ip": r"[0-9](?:\.| ?[\[(]| (?:\.|[Dd]))"}  # cheap tests
KEYWORD = r"(?i)(pass|pwd|secret|token|key|tel|phone|call|card|visa|account|contact)[^\n]{0,6}$"
BYTE = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
SPAN = "array<struct<start:int,stop:int,s:string>>"


def maybe(kind: str, text: Column) -> Column:
    """A cheap test that no text with a span of this kind fails."""
    return {
        "email": F.contains(text, F.lit("@")),
        "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
        "phone": F.contains(text, F.lit("+")),
    }[kind]


def matched(text: Column, pattern: str) -> Column:
    """All matches with their code point offsets."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.array(F.struct(begin.alias("start"), end.alias("stop"), x["hit"].alias("s")))
        return F.when(x["hit"].isNull(), a).otherwise(F.struct(end.alias("at"), F.concat(a["out"], span).alias("out")))

    return F.aggregate(parts, start, step, lambda a: a["out"])


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit is right."""
    each = F.filter(F.split(F.reverse(number), ""), lambda c: c != "")

    def value(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(each, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def is_card(s: Column) -> Column:
    return F.length(digits(s)).between(13, 19) & luhn(digits(s))


def is_ip(s: Column) -> Column:
    return F.forall(F.split(s, r"\."), lambda p: p.rlike(BYTE))


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda s: F.lit(True),
    "ip": is_ip,
    "card": is_card,
    "phone": lambda s: F.length(digits(s)).between(9, 15),
}


def base_spans(kind: str, text: Column) -> Column:
    found = F.filter(matched(text, PATTERNS[kind]), lambda x: VALID[kind](x["s"]))
    return F.when(maybe(kind, text), found).otherwise(F.array().cast(SPAN))


def proposed(kind: str, text: Column) -> Column:
    """Candidates of a kind with their surroundings."""
    found = matched(text, CANDIDATES[kind])
    near = lambda x: F.substring(text, F.greatest(x["start"] - 23, F.lit(1)), F.least(x["start"], F.lit(24)))
    dressed = F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), x["s"].alias("s"), near(x).alias("before"), F.substring(text, x["stop"] + 1, F.lit(1)).alias("after")))
    there = text.rlike(MAYBE.get(kind, "[0-9]"))
    return F.when(there, dressed).otherwise(F.array().cast("array<struct<kind:string,start:int,stop:int,s:string,before:string,after:string>>"))


def listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["stop"]))


def bucket(value: Column, cuts: list[int]) -> Column:
    out = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        out = F.when(value < cuts[i], F.lit(i)).otherwise(out)
    return out


def features(c: Column) -> list[Column]:
    """Format and context of a candidate as small integers, without what settles its kind."""
    kind, s, last = c["kind"], F.ltrim(c["s"], F.lit("+")), F.right(c["before"], F.lit(1))
    flag = lambda x: F.when(x, 1).otherwise(0)
    is_address, is_secret = kind.isin("email", "ip"), kind == "secret"
    local = F.when(kind == "ip", F.regexp_extract(s, "^[0-9]+", 0)).otherwise(F.regexp_extract(s, f"^{LOCAL}+", 0))
    ending = F.regexp_extract(s, "[A-Za-z0-9-]+$", 0)
    shape = F.when(kind == "email", F.when(local.rlike("[0-9]"), 2).when(local.rlike("[._%+-]"), 1).otherwise(0)).when(kind == "ip", bucket(F.length(ending), [2, 3, 4]))
    return [
        F.array_position(F.array(*map(F.lit, CANDIDATES)), kind).cast("int") - 1,
        bucket(F.length(digits(s)), [9, 13, 16, 20]),
        F.when(is_address, bucket(F.length(local), [2, 3, 4, 12, 24])).otherwise(bucket(F.length(s), [12, 20, 36])),
        flag(~is_secret & c["before"].rlike(KEYWORD)),
        F.when(last.rlike(r'[=:"]'), 1).when(last.rlike(r"[./@_-]") & ~is_secret, 2).otherwise(0),
        F.when(is_secret, 0).when(c["after"].rlike(r'["]'), 1).when(c["after"].rlike("[./@_-]"), 2).otherwise(0),
        F.when(is_address, 0).when(s.rlike(r"[(]"), 3).when(s.rlike(r"[.]"), 2).when(s.rlike("[ -]"), 1).otherwise(0),
        F.when(kind == "email", bucket(F.length(ending), [2, 3, 4, 7])).otherwise(flag(s.rlike("^[0-9a-f]+$"))),
        F.coalesce(shape, F.lit(0)),
    ]


def settled(c: Column) -> Column:
    """1 or 0 for candidates that rules settle, else null."""
    kind, s = c["kind"], c["s"]
    n, plain_ip = F.length(digits(s)), s.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    assigned = c["before"].rlike(r'(?i)(pass|pwd|secret|token|key)\w*\s{0,2}[=:]\s{0,2}"?$')
    return (
        F.when(kind == "email", F.when(s.contains("@"), 1).when(s.rlike("(?i) at ") & ~s.rlike("(?i) dot |[\\[(]"), 0))
        .when(kind == "ip", F.when(plain_ip, F.when(is_ip(s), 1).otherwise(0)))
        .when(kind == "phone", F.when(s.startswith("+"), F.when(n.between(9, 15), 1).otherwise(0)).when(plain_ip | ((n >= 13) & is_card(s)), 0))
        .when(kind == "card", F.when(n.between(13, 19), F.when(is_card(s), 1).otherwise(0)))
        .otherwise(F.when(assigned, 1).when(c["after"].isin("@", "/", ".") | c["before"].rlike(r"[@/.]$") | s.rlike("^([A-Za-z]+|[0-9]+)([_-]+([A-Za-z]+|[0-9]+))+$"), 0))
    )


def fit_trees(docs: DataFrame, text: Column, fold: Column) -> tuple[BoostedTrees | None, dict[str, float], dict[str, list[str]]]:
    """Trees, for each kind the probability from which the unseen fold's labelled candidates are right in 95 of 100 cases,
    and the features (as text) that positive ones have."""
    proposals = F.concat(*(proposed(k, text) for k in CANDIDATES))
    rows = docs.select(F.explode(proposals).alias("c"), fold.alias("fold"))
    named = [f.alias(f"f{i}") for i, f in enumerate(features(F.col("c")))]
    keys = [f"f{i}" for i in range(len(named))]
    counted = rows.select(F.when(F.col("fold") == 0, 0).otherwise(1).alias("fold"), settled(F.col("c")).alias("y"), *named).where("y is not null").groupBy("fold", "y", *keys).count().collect()
    table: dict[tuple[int, ...], np.ndarray] = {}
    for r in counted:
        table.setdefault(tuple(r[k] for k in keys), np.zeros((2, 2)))[r.fold, r.y] += r["count"]
    if not table:
        return None, {}, {}
    combos = sorted(table)
    x, n = np.array(combos), np.array([table[c] for c in combos])
    trees = BoostedTrees(x, n[:, 1, 1], n[:, 1, 0])
    p, thresholds, known = trees.probabilities(x), {}, {}
    for i, kind in enumerate(CANDIDATES):
        own = x[:, 0] == i
        good, bad, q = n[own, 0, 1], n[own, 0, 0], p[own]
        order = np.argsort(-q, kind="stable")
        right, wrong = np.cumsum(good[order]), np.cumsum(bad[order])
        fine = np.flatnonzero((right >= 19 * wrong) & (right > 0) & np.append(np.diff(q[order]) < 0, True))
        thresholds[kind] = max(0.5, float(q[order][fine[-1]])) if len(fine) else 1.0
        known[kind] = [",".join(map(str, combos[j])) for j in np.flatnonzero(own & (n[:, :, 1].sum(1) > 0))]
    return trees, thresholds, known


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone (base spans), base_spans and spans (arrays of kind:start:end)."""
    docs = docs.drop("n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans")
    body = F.coalesce(F.col(text), F.lit(""))
    trees, thresholds, known = fit_trees(docs.select(id, text), body, F.pmod(F.xxhash64(text), F.lit(5)))
    of_kind, every_base = {k: fresh(docs, f"own_{k}") for k in PATTERNS}, fresh(docs, "own_base")
    found = docs
    for kind in PATTERNS:
        found = found.withColumn(of_kind[kind], base_spans(kind, body))
    every = F.concat(*of_kind.values())
    found = found.withColumn(every_base, F.transform(every, lambda x: F.struct(x["start"], x["stop"])))
    kinds = []
    for kind in ("email", "ip", "card", "phone", "secret"):
        own = F.transform(of_kind[kind], lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))) if kind in PATTERNS else F.array().cast("array<struct<start:int,stop:int>>")
        if trees is not None and kind in CANDIDATES and thresholds[kind] < 1:
            cut = math.log(thresholds[kind] / (1 - thresholds[kind])) - 1e-9
            good = F.filter(proposed(kind, body), lambda c: F.concat_ws(",", *features(c)).isin(known[kind]) & (trees.log_odds(features(c)) >= cut))
            good = F.transform(good, lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop")))
            new = F.filter(good, lambda c: ~F.exists(every_base, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
            own = F.array_sort(F.concat(own, new))
        kinds.append(listed(kind, own))
    base = F.concat(*(listed(k, F.col(of_kind[k])) for k in PATTERNS))
    counts = {f"n_{k}": F.size(of_kind[k]).cast("long") for k in PATTERNS}
    return found.withColumns({**counts, "base_spans": base, "spans": F.concat(*kinds)}).drop(every_base, *of_kind.values())
