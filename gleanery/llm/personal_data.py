"""Personal data by weak supervision, in DataFrame and SQL functions only.

Patterns propose spans: the strict base patterns and wider ones. Five labelers (pattern, checksum and format, gazetteer of trigger words,
context to the left, edges) vote on each span or abstain. The votes' patterns are counted in Spark; there are at most
3 ** 5 for each kind, and expectation-maximisation over these counts estimates how reliable each labeler is. The resulting
soft labels train a span classifier on the span's shape, its neighbours and its votes, again from counts. Spans of the base
patterns always stay; a wider one is added where the classifier believes it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialize

#: Base patterns. Runs are matched possessively and only from their first character, which finds the same spans in linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
#: Wider patterns, each with the kind of span that it proposes.
WIDER = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]++)++"),
    ("phone", r"(?<![0-9+-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])"),
    ("id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("secret", r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])"),
)
KINDS = ("email", "ip", "card", "phone", "id", "iban", "secret")
TRIGGERS = {
    "email": "mail|contact|kontakt|contacto|write|schreib|écri|escrib",
    "ip": "\\\\bip\\\\b|server|host|address|adresse|dirección",
    "card": "card|karte|carte|tarjeta|visa|master|credit|payment",
    "phone": "phone|tel|call|fax|mobile|handy|anruf|appel|llam|contact",
    "id": "ssn|social|security|id|passport|ausweis",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "secret": "token|key|secret|password|passwort|clave|clé|api|auth",
}
#: What shows that a span is something else: versions, book numbers, prices, and hexadecimal digits on either side.
AGAINST = "(?:version|isbn|issn|doi|nr\\\\.|no\\\\.|§|[$€£#]) ?$"
AROUND = 32
LABELERS = 5
ROUNDS = 50
SPAN = "struct<kind:int,start:int,end:int,base:boolean,text:string,before:string,after:string>"


def matches(text: Column, pattern: str, passing: Callable[[Column], Column] = lambda match: F.lit(True)) -> Column:
    """array<struct<start, end, text>>: those of the leftmost non-overlapping matches that pass, in code points, end exclusive.

    Only what passes is listed, so a text full of numbers costs no more than its length.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(both: Column) -> Column:
        # Gaps and matches alternate: a match starts behind all the gaps and matches before it.
        gaps = F.split(text, pattern, -1)
        sizes = F.zip_with(gaps, both, lambda gap, match: F.struct(F.char_length(gap).alias("gap"), F.coalesce(F.char_length(match), F.lit(0)).alias("n"), match.alias("text")))
        empty = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")
        state = F.struct(F.lit(0).alias("at"), empty.alias("out"))

        def step(s: Column, x: Column) -> Column:
            start = s["at"] + x["gap"]
            span = F.struct(start.alias("start"), (start + x["n"]).alias("end"), x["text"].alias("text"))
            return F.struct((start + x["n"]).alias("at"), F.when(x["text"].isNotNull() & passing(x["text"]), F.concat(s["out"], F.array(span))).otherwise(s["out"]).alias("out"))

        return F.aggregate(sizes, state, step, lambda s: s["out"])

    none = F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)")
    return _let(found, lambda both: F.when(F.size(both) > 0, placed(both)).otherwise(none))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn check."""
    places = F.transform(F.filter(F.split(F.reverse(_digits(text)), ""), lambda d: d != ""), lambda d, i: F.struct(d.cast("int").alias("d"), (i % 2).alias("odd")))
    values = F.transform(places, lambda x: F.when(x["odd"] == 0, x["d"]).otherwise(x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def passes(kind: str, text: Column) -> Column:
    """The check that a base match of a kind must pass."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
        return text.rlike(rf"^{part}(?:\.{part}){{3}}$")
    size = F.char_length(_digits(text))
    if kind == "card":
        return F.when(size.between(16, 19), luhn(text)).otherwise(False)
    return size.between(8, 15)


def base_spans(text: Column, kind: str) -> Column:
    pattern = dict(BASE)[kind]
    hint = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
    found = matches(text, pattern, lambda match: passes(kind, match))
    if hint is None:
        return found
    return F.when(F.contains(text, F.lit(hint)), found).otherwise(F.expr("cast(array() as array<struct<start:int,end:int,text:string>>)"))


def proposals(text: Column) -> Column:
    """All spans of a text as ``SPAN``: base ones, and wider ones that overlap no base span. A null text has none."""
    text = F.coalesce(text, F.lit(""))

    def dressed(spans: Column, kind: str, base: bool) -> Column:
        return F.transform(
            spans,
            lambda x: F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                x["start"].alias("start"),
                x["end"].alias("end"),
                F.lit(base).alias("base"),
                x["text"].alias("text"),
                F.substring(text, F.greatest(x["start"] - AROUND, F.lit(0)) + 1, F.least(x["start"], F.lit(AROUND))).alias("before"),
                F.substring(text, x["end"] + 1, F.lit(AROUND)).alias("after"),
            ),
        )

    strict = F.concat(*[dressed(base_spans(text, kind), kind, True) for kind, _ in BASE])
    wider = F.concat(*[dressed(matches(text, pattern), kind, False) for kind, pattern in WIDER])

    def merged(strict: Column) -> Column:
        free = F.filter(wider, lambda x: ~F.exists(strict, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
        return F.concat(strict, free)

    return _let(strict, merged)


def _by_kind(span: Column, values: dict[str, Column]) -> Column:
    out = F.lit(0)
    for kind, value in values.items():
        out = F.when(span["kind"] == KINDS.index(kind), value).otherwise(out)
    return out


def votes(span: Column) -> list[Column]:
    """1 for personal data, -1 against, 0 to abstain, of each labeler."""
    digits = F.char_length(_digits(span["text"]))
    pattern = F.when(span["base"], 1).otherwise(0)
    checks = _by_kind(
        span,
        {
            "ip": F.when(passes("ip", span["text"]), 1).otherwise(-1),
            "card": F.when(luhn(span["text"]), 1).otherwise(-1),
            "phone": F.when(digits.between(8, 15), 1).otherwise(-1),
            "id": F.when(span["text"].rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), 1).otherwise(-1),
            "iban": F.when(digits >= 10, 1).otherwise(-1),
            "secret": F.when(span["text"].rlike("[0-9]") & span["text"].rlike("[a-f]"), 1).otherwise(-1),
        },
    )
    near = F.lower(F.concat(span["before"], F.lit(" "), span["after"]))
    gazetteer = _by_kind(span, {kind: F.when(near.rlike(f"(?:{words})".replace("\\\\", "\\")), 1).otherwise(0) for kind, words in TRIGGERS.items()})
    context = F.when(F.lower(span["before"]).rlike(AGAINST.replace("\\\\", "\\")), -1).otherwise(0)
    joined = span["before"].rlike(r"[\p{L}\p{N}_]$") | span["after"].rlike(r"^[\p{L}\p{N}_]")
    edges = F.when(joined, -1).otherwise(1)
    return [pattern, checks, gazetteer, context, edges]


def shape(span: Column) -> list[Column]:
    """What the classifier sees besides the votes: kind, length class, kinds of characters, neighbours."""
    size = F.least(F.floor(F.log2(F.char_length(span["text"]).cast("double"))), F.lit(7)).cast("int")
    characters = F.when(span["text"].rlike("[A-Za-z]"), 1).otherwise(0) + F.when(span["text"].rlike("[^A-Za-z0-9]"), 2).otherwise(0)
    left = F.when(span["before"] == "", 0).when(span["before"].rlike(r"\s$"), 1).when(span["before"].rlike(r"[\p{P}\p{S}]$"), 2).otherwise(3)
    right = F.when(span["after"] == "", 0).when(span["after"].rlike(r"^\s"), 1).when(span["after"].rlike(r"^[\p{P}\p{S}]"), 2).otherwise(3)
    return [span["kind"], span["kind"] * 8 + size, span["kind"] * 4 + characters, left, right]


def em(counts: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """(prior, for each labeler vote -> (chance if personal, chance if not)) from counts of vote patterns.

    Starts from the majority of the votes; the labelers are taken as independent given the truth.
    """
    soft = {v: 1 / (1 + math.exp(-1.5 * sum(v))) for v in counts}
    prior, rates = 0.5, []
    for _ in range(rounds):
        total = sum(counts.values())
        yes = sum(n * soft[v] for v, n in counts.items())
        prior = (yes + 1) / (total + 2)
        rates = []
        for j in range(LABELERS):
            seen = {x: [0.5, 0.5] for x in (-1, 0, 1)}
            for v, n in counts.items():
                seen[v[j]][0] += n * soft[v]
                seen[v[j]][1] += n * (1 - soft[v])
            sums = [sum(s[i] for s in seen.values()) for i in (0, 1)]
            rates.append({x: (s[0] / sums[0], s[1] / sums[1]) for x, s in seen.items()})
        soft = {v: posterior(v, prior, rates) for v in counts}
    return prior, rates


def posterior(v: tuple[int, ...], prior: float, rates: list[dict[int, tuple[float, float]]]) -> float:
    odds = math.log(prior / (1 - prior)) + sum(math.log(rates[j][x][0] / rates[j][x][1]) for j, x in enumerate(v))
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


@dataclass(frozen=True)
class SpanClassifier:
    """Log-odds of a span: ``base`` and, for each feature in turn, a table of its values."""

    base: float
    tables: tuple[tuple[tuple[int, float], ...], ...]

    def log_odds(self, span: Column) -> Column:
        out = F.lit(self.base)
        for value, table in zip([*votes(span), *shape(span)], self.tables, strict=True):
            if table:
                weights = F.create_map(*[F.lit(x) for pair in table for x in pair])
                out = out + F.coalesce(F.try_element_at(weights, value.cast("int")), F.lit(0.0))
        return out


def train(docs: DataFrame, text: str = "text") -> SpanClassifier:
    """Labelers' reliabilities and the classifier, from the spans of all rows. Without spans, nothing is ever added."""
    spans = docs.select(F.explode(proposals(F.col(text))).alias("x"))
    names = [f"v{i}" for i in range(LABELERS)] + [f"s{i}" for i in range(5)]
    values = spans.select(*[c.cast("int").alias(n) for c, n in zip([*votes(F.col("x")), *shape(F.col("x"))], names, strict=True)])
    # Spans of equal votes and shape are one row with a count: the rows are bounded by the values, not by the texts.
    counted = materialize(values.groupBy(*names).agg(F.count("*").alias("n")), "pii-patterns")
    by_votes = counted.groupBy(*names[:LABELERS]).agg(F.sum("n").alias("n")).collect()
    if not by_votes:
        return SpanClassifier(-1.0, ((),) * len(names))
    counts = {tuple(r[f"v{i}"] for i in range(LABELERS)): r["n"] for r in by_votes}
    prior, rates = em(counts)
    soft = F.lit(0.0)
    for v in counts:
        same = F.lit(True)
        for i, x in enumerate(v):
            same = same & (F.col(f"v{i}") == x)
        soft = F.when(same, F.lit(posterior(v, prior, rates))).otherwise(soft)
    weighed = counted.withColumn("soft", soft)
    features = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(n).alias("value")) for i, n in enumerate(names)])).alias("x")
    sums = weighed.select("n", "soft", features).groupBy("x.f", "x.value").agg(F.sum(F.col("n") * F.col("soft")).alias("yes"), F.sum(F.col("n") * (1 - F.col("soft"))).alias("no")).collect()
    tables = []
    for i in range(len(names)):
        rows = [r for r in sums if r["f"] == i]
        yes, no = sum(r["yes"] for r in rows) + len(rows), sum(r["no"] for r in rows) + len(rows)
        # Features share what they know: each counts half, so agreeing ones don't overstate it.
        tables.append(tuple((r["value"], 0.5 * math.log((r["yes"] + 1) / yes * no / (r["no"] + 1))) for r in sorted(rows, key=lambda r: r["value"])))
    return SpanClassifier(math.log(prior / (1 - prior)), tuple(tables))


def accepted(text: Column, model: SpanClassifier) -> Column:
    """The base spans and the wider ones that the classifier believes, by kind, then start."""
    believed = F.filter(proposals(text), lambda x: x["base"] | (model.log_odds(x) >= 0))
    return F.sort_array(believed)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _equals(value: int) -> Callable[[Column], Column]:
    # A lambda with a second parameter, be it a default, would be handed the element's index.
    return lambda x: x == value


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans), spans (all spans) of every whole text.

    A null text has no spans. Repeated rows stay; other columns are ignored; an empty table stays empty.
    """
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    model = train(rows)
    found = rows.select(key, accepted(F.col("text"), model).alias("spans"))
    base = F.filter("spans", lambda x: x["base"])
    kinds = F.transform(base, lambda x: x["kind"])
    counts = [F.size(F.filter(kinds, _equals(i))).cast("long").alias(f"n_{k}") for i, (k, _) in enumerate(BASE)]
    return found.select(key, *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span of their text replaced by its kind in brackets, like ``[EMAIL]``.

    Of spans that overlap the one that starts first (the longer, if both do) is replaced whole, up to the end of the last that it
    meets. Null texts stay null. All other columns and repeated rows stay.
    """
    model = train(docs.select(F.col(text).alias("text")))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def replaced(spans: Column) -> Column:
        order = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("end"), x["kind"].alias("kind"))))
        state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

        def step(s: Column, x: Column) -> Column:
            fresh = x["start"] >= s["at"]
            out = F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, x["start"] - s["at"]), F.get(names, x["kind"]))
            return F.struct(F.greatest(s["at"], -x["end"]).alias("at"), F.when(fresh, out).otherwise(s["out"]).alias("out"))

        whole = F.aggregate(order, state, step, lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.char_length(F.col(text)))))
        return F.when(F.size(spans) > 0, whole).otherwise(F.col(text))

    return docs.withColumn(text, _let(accepted(F.col(text), model), replaced))
