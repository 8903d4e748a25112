"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

Candidates are the strict matches of four kinds (email, ip, card, phone) and looser forms of them
(written-out emails, phone numbers without a plus, card numbers with a wrong check digit, IPv6).
Strict matches that keep their rule are always spans. Five labelers vote on each candidate (rule,
gazetteer, context words, boundary, repetition) with -1, 0 or 1. Counts per vote pattern, at most
4 kinds x 3^5 votes x 2^4 shapes, are all that leaves the executors: EM over them estimates every
labeler's reliability without labels, and a logistic regression on votes and shape is fitted to its
posteriors. The classifier adds looser candidates that it is sure of and that touch no strict span.

Spans are code points, end exclusive. Built-in functions only; a text is read once per pass and never
cut. Defined results: null text has no spans and stays null; a null id is kept; repeated rows are scored row by row; an
empty table gives no rows; without loose candidates nothing is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("rule", "gazetteer", "context", "boundary", "repetition")
SHAPES = 4
THRESHOLD = 0.9

SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,shape:int>>"

# Strict patterns. Possessive loops and the look-behinds leave the matches as they are (a match that
# fails from the start of a run fails from inside it) but keep time linear in long runs.
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
# the whole run of digits, single spaces or hyphens between them, if it has 13 to 19
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

# Looser forms.
LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)+"
LOOSE_PHONE = r"(?<![0-9+.(-])(?<![0-9+] )\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![ .-]?[0-9])"
LOOSE_IP = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"

TOP_LEVEL = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|it|nl|ch|at|us|ca"
CUES = {
    "email": "mail|contact|write|reach",
    "ip": r"\bip\b|host|server|addr|login",
    "card": "card|visa|credit|debit|payment|pan\\b",
    "phone": "tel|phone|call|mobile|cell|fax",
}
OTHER = r"version|release|isbn|order|invoice|serial|\bref\b|\bid\b|section|doi"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` with `value` computed once, however often it is used inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check sum over at most 19 digits."""

    def part(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    single = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(single, part), F.lit(0), lambda a, x: a + x) % 10 == 0


def _ip_valid(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda p: p.rlike("^0*[0-9]{1,3}$") & (F.right(p, F.lit(3)).cast("int") <= 255))


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1, -1 or 0; one condition votes both ways."""
    if no is None:
        return F.when(yes, 1).otherwise(-1)
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, m: Column) -> Column:
    if kind == "email":
        return _vote(F.lower(m).rlike(rf"[.)\] ](?:{TOP_LEVEL})$"))
    if kind == "ip":
        return _vote(~m.rlike(r"^(?:0+\.|127\.|22[4-9]\.|2[3-5][0-9]\.|0+:)"))
    if kind == "card":
        return _vote(_digits(m).rlike("^(?:4|5[1-5]|2[2-7]|3[0-9]|6[0-9])"))
    return _vote(m.rlike(r"^\+[1-9]|^\(?[2-9]"))


def _candidate(kind: str, rule: Column, base: Column, x: Column, start: Column) -> Column:
    m, left, right = x["m"], x["left"], x["right"]
    near = F.lower(F.right(left, F.lit(40)))
    votes = F.array(
        rule,
        _gazetteer(kind, m),
        _vote(near.rlike(CUES[kind]), near.rlike(OTHER)),
        _vote(left.rlike(r"(?:^|[\s\"'(<\[:;,=|])$") & right.rlike(r"^(?:$|[\s\"')>\],.;:!?|])")),
        F.when(_digits(m).rlike("^([0-9])\\1{6,}$") | F.lower(m).rlike("no-?reply|example@|^0\\."), -1).otherwise(0),
    )
    shape = (
        m.contains(" ").cast("int") + 2 * m.rlike("[()\\[\\]]").cast("int")
        + 4 * (F.length(m) > 16).cast("int") + 8 * left.rlike("[:=]\\s?$").cast("int")
    )
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), start.cast("int").alias("start"), (start + F.length(m)).cast("int").alias("end"),
        base.alias("base"), votes.alias("votes"), shape.cast("int").alias("shape"),
    )


def _spans(text: Column, pattern: str, keep: Callable[[Column], Column], make: Callable[[Column, Column], Column]) -> Column:
    """Matches that `keep`, as `make(x, start)`, by adding up the lengths of what lies between matches."""
    empty = F.array().cast(SPANS)

    def walk(cut: Column) -> Column:
        around = F.transform(
            cut["found"], lambda m, i: F.struct(cut["gaps"][i].alias("left"), m.alias("m"), cut["gaps"][i + 1].alias("right"))
        )

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["left"])
            return F.struct(
                (start + F.length(x["m"])).alias("at"),
                F.when(keep(x["m"]), F.array_append(acc["out"], make(x, start))).otherwise(acc["out"]).cast(SPANS).alias("out"),
            )

        return F.aggregate(around, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])

    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    return let(cut, walk)


def candidates(text: Column) -> Column:
    """All candidates of a text (`SPANS`), strict ones marked `base`; texts without any skip the walk."""
    yes, no, unsure = F.lit(True), F.lit(False), F.lit(0)
    empty = F.array().cast(SPANS)

    def found(hint: Column, kind: str, pattern: str, keep, base, rule) -> Column:
        spans = _spans(text, pattern, keep, lambda x, at: _candidate(kind, rule(x["m"]), base(x["m"]), x, at))
        return F.when(hint, spans).otherwise(empty)

    def sure(m: Column) -> Column:
        return F.lit(1)

    parts = [
        found(text.contains("@"), "email", EMAIL, lambda m: yes, lambda m: yes, sure),
        found(text.rlike(IP), "ip", IP, _ip_valid, lambda m: yes, sure),
        found(text.rlike(CARD), "card", CARD, lambda m: yes, lambda m: luhn(_digits(m)), lambda m: _vote(luhn(_digits(m)))),
        found(text.contains("+"), "phone", PHONE, lambda m: F.length(_digits(m)).between(9, 15), lambda m: yes, sure),
        found(text.contains("at)") | text.contains("at]"), "email", LOOSE_EMAIL, lambda m: yes, lambda m: no, lambda m: unsure),
        found(text.rlike("[0-9]{3}[ .-][0-9]{4}(?![0-9])"), "phone", LOOSE_PHONE, lambda m: yes, lambda m: no, lambda m: unsure),
        found(text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:"), "ip", LOOSE_IP, lambda m: yes, lambda m: no, lambda m: unsure),
    ]
    return F.concat(*parts)


@dataclass(frozen=True)
class Model:
    """Per kind: a constant, a weight per (labeler, vote) and a weight per shape bit."""

    constant: list[float]
    votes: list[list[float]]
    shapes: list[list[float]]
    reliability: dict[str, list[float]]


def fit(found: DataFrame) -> Model:
    """EM and the classifier from the column `cands`; collects counts of at most 4 x 3^5 x 2^4 x 2 patterns."""
    counts = (
        found.select(F.explode("cands").alias("c"))
        .groupBy("c.kind", "c.votes", "c.shape", "c.base").count().orderBy("kind", "votes", "shape", "base").collect()
    )
    constant, votes, shapes, reliability = [], [], [], {}
    for k, name in enumerate(KINDS):
        rows = [r for r in counts if r["kind"] == k]
        v = np.array([r["votes"] for r in rows], dtype=int).reshape(-1, len(LABELERS))
        s = np.array([[(r["shape"] >> b) & 1 for b in range(SHAPES)] for r in rows], dtype=float).reshape(-1, SHAPES)
        n = np.array([r["count"] for r in rows], dtype=float)
        strict = np.array([r["base"] for r in rows], dtype=bool)
        posterior, reliability[name] = _reliabilities(v, n, strict)
        w = _logistic(_features(v, s), posterior, n)
        constant.append(float(w[0]))
        votes.append([float(x) for x in w[1:1 + 2 * len(LABELERS)]])
        shapes.append([float(x) for x in w[1 + 2 * len(LABELERS):]])
    return Model(constant, votes, shapes, reliability)


def _features(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    """A constant, (vote is 1, vote is -1) per labeler, the shape bits."""
    each = np.stack([v == 1, v == -1], axis=2).reshape(len(v), 2 * len(LABELERS)).astype(float)
    return np.hstack([np.ones((len(v), 1)), each, s])


def _reliabilities(v: np.ndarray, n: np.ndarray, strict: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, list[float]]:
    """P(span) per pattern, and P(vote is right | labeler votes) per labeler.

    Labelers count as independent given the truth; a strict span is known to be one. Starts from the
    majority of votes; a prior of a few votes for an honest labeler keeps rare patterns from flipping it.
    """
    if not len(v):
        return np.zeros(0), [0.5] * len(LABELERS)
    p = np.where(strict, 1.0, 1 / (1 + np.exp(-v.sum(1).astype(float))))
    honest = {1: np.array([1.0, 2.0, 4.0]), 0: np.array([4.0, 2.0, 1.0])}  # votes -1, 0, 1
    table = {}
    for _ in range(rounds):
        for truth, weight in ((1, p), (0, 1 - p)):
            seen = np.stack([((v == x) * (weight * n)[:, None]).sum(0) for x in (-1, 0, 1)], axis=1)
            seen = seen + honest[truth]
            table[truth] = seen / seen.sum(1, keepdims=True)
        prior = (1 + (p * n).sum()) / (2 + n.sum())
        index = np.arange(len(LABELERS))
        like = {t: np.log(table[t][index, v + 1]).sum(1) for t in (0, 1)}
        z = like[1] - like[0] + math.log(prior / (1 - prior))
        p = np.where(strict, 1.0, 1 / (1 + np.exp(-np.clip(z, -30, 30))))
    cast = (v != 0) * n[:, None]
    right = ((v == 1) * (p * n)[:, None] + (v == -1) * ((1 - p) * n)[:, None]).sum(0)
    return p, [float(x) for x in np.where(cast.sum(0) > 0, right / np.maximum(cast.sum(0), 1e-9), 0.5)]


def _logistic(x: np.ndarray, target: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on soft targets by Newton steps over the patterns."""
    width = 1 + 2 * len(LABELERS) + SHAPES
    w = np.zeros(width)
    if not len(x):
        w[0] = -10.0
        return w
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (target - q)) - ridge * w
        curve = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(width)
        step = np.linalg.solve(curve, gradient)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _probability(model: Model, c: Column) -> Column:
    def of(weights: list[float]) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in weights]), c["kind"] + 1)

    z = of(model.constant)
    for i in range(len(LABELERS)):
        vote = c["votes"][i]
        z = z + F.when(vote == 1, of([w[2 * i] for w in model.votes])).when(vote == -1, of([w[2 * i + 1] for w in model.votes])).otherwise(0.0)
    for b in range(SHAPES):
        z = z + F.when(c["shape"].bitwiseAND(1 << b) != 0, of([w[b] for w in model.shapes])).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def strict_spans(cands: Column) -> Column:
    """Rule-keeping spans (kind, start, end), by kind, then start."""
    kept = F.filter(cands, lambda c: c["base"])
    return F.array_sort(F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))


def all_spans(cands: Column, model: Model, threshold: float = THRESHOLD) -> Column:
    """Strict spans and the looser ones the classifier is sure of, by kind, then start."""

    def touch(a: Column, b: Column) -> Column:
        return (a["start"] < b["end"]) & (b["start"] < a["end"])

    def choose(both: Column) -> Column:
        free = F.filter(both["loose"], lambda c: ~F.exists(both["strict"], lambda s: touch(c, s)) & (_probability(model, c) >= threshold))

        def first(x: Column) -> Column:
            # of loose spans that touch, the one listed first stays
            return F.filter(x, lambda c, i: ~F.exists(F.slice(x, 1, F.greatest(i, F.lit(0))), lambda o: touch(c, o)))

        bare = F.transform(let(free, first), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
        return F.array_sort(F.concat(both["strict"], bare))

    return let(F.struct(strict_spans(cands).alias("strict"), F.filter(cands, lambda c: ~c["base"]).alias("loose")), choose)


def count_kind(spans: Column, kind: str) -> Column:
    # a second parameter of the lambda, a default too, would be the element's index
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind)))


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """`text` with each span, or group of overlapping spans, replaced by its first kind in angle brackets."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))

    def step(acc: Column, s: Column) -> Column:
        between = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.array_append(acc["out"], F.concat(between, names[s["kind"]]))).otherwise(acc["out"]).alias("out"),
        )

    def close(acc: Column) -> Column:
        return F.array_join(F.array_append(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))), "")

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, close)).otherwise(text)


def redact_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with personal data in `text` replaced and `n_chars`, if there, counted again.

    The first pass only counts patterns; the second finds the spans again, so no text is stored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    model = fit(docs.select(candidates(text).alias("cands")))
    found = docs.select(F.struct("*").alias("_row"), candidates(text).alias("_cands"))
    spans = found.select("_row", all_spans(F.col("_cands"), model, threshold).alias("_spans"))
    clean = spans.select("_row", redact(F.col("_row.text"), F.col("_spans")).alias("_text"))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("_text"), F.col("_row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])
