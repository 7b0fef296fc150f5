"""Personal data by weak supervision (DataFrame functions only).

Base spans follow fixed patterns (email, ip, card, phone). The method adds
spans that those patterns miss: identity numbers, phone numbers without a
country code and credentials. Candidates are all raw matches of the base
patterns and of broader ones. Five labelers (format, checksum, gazetteer,
context, shape) vote yes, no or nothing on each; expectation-maximisation
estimates every labeler's reliability from the counts of vote patterns alone,
and a logistic span classifier is trained on the resulting soft labels with
features that the labelers do not look at one by one (kind, length, share of
digits, neighbouring characters). A candidate that the classifier accepts and
that touches no base span becomes an added span.

Everything per text is one projection: patterns, positions (code points, from
the pieces between matches), votes, features. The counts that the driver's
arithmetic sees are one row per combination of votes and features, bounded by
their number of levels, whatever the data's size. The scan's narrow result
(spans, no texts) is written once.

The patterns are possessive forms of the contract's, so long runs of digits or
letters neither backtrack nor recurse; they find the same matches (of cards,
those with the 14 digits that a card needs).

Edge cases: null and empty texts have no spans; equal starts are ordered by
kind; repeated rows get their own result; without candidates nothing is
added; an empty table gives an empty result; extra columns are ignored (kept
by :func:`mask_documents`).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

#: fixed values: base patterns by kind, in the order of the contract
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: broader patterns of the method, after the base kinds
BROAD = {
    "national_id": r"(?<![A-Za-z0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "local_phone": r"(?<![A-Za-z0-9+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9-])",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{16,}+",
}
KINDS = [*BASE, *BROAD]
VOTES = ("format", "checksum", "gazetteer", "context", "shape")
FEATURES = ("kind", "size", "digits", "before")
_FIELDS = r"(?i)(?:pass(?:word|wd)?|pwd|token|secret|api|key|auth|ssn|social|id|iban|account|card|visa|phone|tel|mobile|fax|call|e-?mail|mail|contact|ip|host|addr(?:ess)?)[^A-Za-z0-9]{0,4}$"
_OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,left:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _raw(text: Column, kind: str, pattern: str) -> Column:
    """All matches with their places and up to 24 characters before them."""
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
                       lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"),
                        F.lit(kind).alias("kind"), x["m"].alias("value"), F.substring(x["gap"], -24, 24).alias("left"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))
    return F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), start, step, lambda acc: acc["found"])


def _valid(s: Column) -> Column:
    """Whether a raw match of a base pattern is a base span."""
    n = F.length(_digits(s["value"]))
    return (F.when(s["kind"] == "email", F.lit(True))
            .when(s["kind"] == "ip", s["value"].rlike(_OCTETS))
            .when(s["kind"] == "card", n.between(14, 19) & F.call_function("luhn_check", _digits(s["value"])))
            .when(s["kind"] == "phone", n.between(10, 15))
            .otherwise(F.lit(False)))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(s: Column) -> list[Column]:
    value, kind, left = s["value"], s["kind"], s["left"]
    n, size = F.length(_digits(value)), F.length(value)
    known = (value.rlike(r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{18}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$")
             | (kind == "email") & value.rlike(r"\.[A-Za-z]{2,}$") | (kind == "phone") & n.between(10, 15)
             | (kind == "ip") & value.rlike(_OCTETS) | (kind == "card") & n.between(14, 19)
             | (kind == "national_id") & ~value.rlike(r"^(?:000|666|9)|-00-|-0000$") | (kind == "local_phone"))
    checked = (kind == "card") | (kind == "secret") & value.rlike("^[0-9_/+-]+$")
    luhn = F.call_function("luhn_check", _digits(value)) & n.between(14, 19)
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return [
        _vote(known, (kind == "ip") & ~value.rlike(_OCTETS) | (kind == "card") & (n < 14) | (kind == "phone") & ~n.between(10, 15)),
        _vote(checked & luhn, checked & ~luhn),
        _vote(left.rlike(_FIELDS), value.rlike(r"^(?:0+|1+)$|(?i)lorem|placeholder|xxxx")),
        _vote(left.rlike(r"[:=]\s{0,2}[\"']?$"), left.rlike(r"[0-9A-Za-z][./_-]$")),
        _vote((kind != "secret") & n.between(9, 19) | mixed & (n * 5 >= size), (n < 7) & (kind != "email") | value.rlike(r"^(?:[A-Za-z]+[_/+-])*[A-Za-z]+[0-9]{0,2}$")),
    ]


def _features(s: Column) -> list[Column]:
    size, n = F.length(s["value"]), F.length(_digits(s["value"]))
    return [
        s["kind"],
        F.when(size <= 8, "8").when(size <= 12, "12").when(size <= 20, "20").when(size <= 40, "40").otherwise("more"),
        F.floor(n * 4 / size).cast("string"),
        F.regexp_replace(F.regexp_replace(F.regexp_replace(F.substring(s["left"], -1, 1), r"\s", "s"), "[A-Za-z]", "a"), "[^sa\"'=:(]", "o"),
    ]


def spans(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``base`` (valid base spans, in order) and ``candidates`` with votes and features."""
    body = F.coalesce(F.col(text), F.lit(""))
    has = {"email": "@", "phone": "+"}
    cols = []
    for kind, pattern in (BASE | BROAD).items():
        searched = F.when(body.contains(has[kind]), body).otherwise("") if kind in has else body
        cols.append(_raw(searched, kind, pattern).alias(kind))
    found = docs.select(*keys, *cols).select(*keys, F.concat(*[F.col(k) for k in KINDS]).alias("raw"))
    found = found.select(*keys, F.array_sort(F.filter("raw", _valid)).alias("base"), F.array_sort("raw").alias("raw"))

    def judged(s: Column) -> Column:
        votes = [v.alias(n) for v, n in zip(_votes(s), VOTES, strict=True)]
        features = [f.alias(n) for f, n in zip(_features(s), FEATURES, strict=True)]
        free = ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), *features, *votes,
                        (free & (s["rank"] >= len(BASE))).alias("addable"))

    slim = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["rank"].alias("rank"), b["end"].alias("end"), b["kind"].alias("kind")))
    return found.select(*keys, slim.alias("base"), F.transform("raw", judged).alias("candidates"))


class SpanModel:
    """Labeler reliabilities and span classifier from counts of vote and feature patterns."""

    def __init__(self, rows: list[dict], rounds: int = 60, steps: int = 300):
        self.reliability: dict[str, dict[int, tuple[float, float]]] = {}
        self.prior = 0.5
        self.bias, self.weights = -1.0, {}
        if rows:
            self._classify(rows, self._reliabilities(rows, rounds), steps)

    def _reliabilities(self, rows: list[dict], rounds: int) -> list[float]:
        """Class-conditional vote rates by expectation-maximisation from the majority vote."""
        soft = [1 / (1 + math.exp(-1.5 * sum(r[v] for v in VOTES))) for r in rows]
        for _ in range(rounds):
            yes = sum(r["n"] * p for r, p in zip(rows, soft, strict=True))
            all_n = sum(r["n"] for r in rows)
            self.prior = (yes + 1) / (all_n + 2)
            for v in VOTES:
                rate = {}
                for value in (-1, 0, 1):
                    a = sum(r["n"] * p for r, p in zip(rows, soft, strict=True) if r[v] == value)
                    b = sum(r["n"] * (1 - p) for r, p in zip(rows, soft, strict=True) if r[v] == value)
                    rate[value] = ((a + 1) / (yes + 3), (b + 1) / (all_n - yes + 3))
                self.reliability[v] = rate
            odds = [math.log(self.prior / (1 - self.prior)) + sum(math.log(self.reliability[v][r[v]][0] / self.reliability[v][r[v]][1]) for v in VOTES) for r in rows]
            soft = [1 / (1 + math.exp(-max(-30.0, min(30.0, o)))) for o in odds]
        return soft

    def _classify(self, rows: list[dict], soft: list[float], steps: int) -> None:
        """Logistic regression on one-hot features and votes, weighted by counts."""
        marks = [[f"{f}={r[f]}" for f in (*FEATURES, *VOTES)] for r in rows]
        names = sorted({m for ms in marks for m in ms})
        self.weights = dict.fromkeys(names, 0.0)
        total, self.bias = sum(r["n"] for r in rows), 0.0
        speed = dict.fromkeys([*names, ""], 1e-8)
        for _ in range(steps):
            slope = {k: 1e-3 * w for k, w in self.weights.items()} | {"": 0.0}
            for r, ms, p in zip(rows, marks, soft, strict=True):
                z = self.bias + sum(self.weights[m] for m in ms)
                e = r["n"] / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p)
                slope[""] += e
                for m in ms:
                    slope[m] += e
            for k, g in slope.items():
                speed[k] += g * g
                change = 0.3 * g / math.sqrt(speed[k])
                if k:
                    self.weights[k] -= change
                else:
                    self.bias -= change

    def logit(self, c: Column) -> Column:
        """The classifier as an expression over a candidate's fields."""
        out = F.lit(float(self.bias))
        for f in (*FEATURES, *VOTES):
            term = F.lit(0.0)
            for name, w in self.weights.items():
                if name.startswith(f + "="):
                    term = F.when(c[f].cast("string") == name[len(f) + 1:], float(w)).otherwise(term)
            out = out + term
        return out


def pattern_counts(found: DataFrame) -> list[dict]:
    """Candidates counted by votes and features (bounded by their levels)."""
    rows = (found.select(F.explode("candidates").alias("c")).groupBy(*[F.col(f"c.{f}").alias(f) for f in (*FEATURES, *VOTES)])
            .agg(F.count("*").alias("n")))
    return sorted((r.asDict() for r in rows.collect()), key=lambda r: tuple(str(r[f]) for f in (*FEATURES, *VOTES)))


def decide(found: DataFrame, model: SpanModel) -> DataFrame:
    """``base`` and ``spans`` (base and accepted candidates, ordered, without overlaps among the added)."""
    accepted = F.filter("candidates", lambda c: c["addable"] & (model.logit(c) >= 0))
    slim = F.transform(accepted, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind")))
    return found.withColumn("spans", F.array_sort(F.concat("base", slim))).drop("candidates")


def written(spans_column: str) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans_column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, keys: list[str], text: str = "text") -> tuple[DataFrame, SpanModel]:
    """Base and all spans of every row, and the model behind the added ones."""
    found = cut_lineage(spans(docs, keys, text), "pii-spans")
    model = SpanModel(pattern_counts(found))
    return decide(found, model), model


def mask_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by its kind in brackets."""
    names = docs.columns
    model = SpanModel(pattern_counts(spans(docs, [], text)))
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    inner = inner.select("row", F.col("row")[text].alias("body"))
    found = decide(spans(inner, ["row"], "body"), model)
    body = F.col("row")[text]

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(body, acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.concat(acc["kept"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["kept"]).alias("kept"))

    masked = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("kept")), step,
                         lambda acc: F.concat(acc["kept"], F.substr(body, acc["at"] + 1, F.length(body))))
    return found.select(*[(F.when(F.size("spans") > 0, masked).otherwise(body) if c == text else F.col("row")[c]).alias(c) for c in names])
