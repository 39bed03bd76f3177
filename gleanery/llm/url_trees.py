"""URL verdicts: rules on host and path, and gradient-boosted trees on lexical features where no rule fits.

DataFrame expressions only. The URLs that a rule fits are the labelled ones; a bounded sample of the different ones, of
both labels and weighted by the rows it stands for, is binned, written once, and each level of a tree is one aggregate over it: gradient and hessian sums by leaf, feature and bin. Only these
sums (leaves x features x bins) reach the driver. The trees then score every URL as plain column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.session import materialize

#: (verdict, host, path): fits the host and its subdomains where the path starts so; the longest fitting rule wins.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Different labelled URLs that trees are fitted on, at most.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, SMOOTH = 10, 3, 16, 0.3, 1.0
#: The commonest suffixes whose statistics a model holds for use without a join; ``suffixes`` has all of them.
SUFFIXES = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CHARACTERS = LOWER + UPPER + "0123456789-._~:/?#=&%+"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for a null or where ``://`` is missing."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(of + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def features(url: Column, host: Column, path: Column, suffix_rate: Column) -> dict[str, Column]:
    """Lexical features of a URL; ``suffix_rate`` is the share of blocked URLs under its host suffix."""
    url = F.coalesce(url, F.lit(""))
    length = F.char_length(url)
    digits = length - F.char_length(F.translate(url, "0123456789", ""))
    counts = F.transform(
        F.array(*[F.lit(c) for c in CHARACTERS]),
        lambda c: (length - F.char_length(F.replace(url, c, F.lit("")))).cast("double") / F.greatest(length, F.lit(1)),
    )
    entropy = F.aggregate(counts, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "length": length.cast("double"),
        "host_length": F.char_length(host).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": digits / F.greatest(length, F.lit(1)),
        "entropy": entropy,
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
        "hyphens": (F.char_length(host) - F.char_length(F.replace(host, F.lit("-"), F.lit("")))).cast("double"),
        "suffix_rate": suffix_rate,
    }


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.element_at(F.split(host, r"\."), -1)


@dataclass(frozen=True)
class Trees:
    """``splits``: for each tree and inner node the feature and threshold (go right where value >= threshold), or None;
    ``leaves``: a value for each leaf; ``rates``: blocked share of the commonest suffixes, ``base``: the overall log-odds and share,
    ``suffixes``: suffix and suffix_rate of all suffixes."""

    splits: tuple[tuple[tuple[str, float] | None, ...], ...]
    leaves: tuple[tuple[float, ...], ...]
    rates: tuple[tuple[str, float], ...]
    base: tuple[float, float]
    suffixes: DataFrame | None = None


def _node(columns: dict[str, Column], splits: Sequence[tuple[str, float] | None], depth: int) -> Column:
    """Number of the node (heap order, the root is 1) that a row reaches after ``depth`` splits."""

    def below(node: int, level: int) -> Column:
        if level == depth:
            return F.lit(node)
        if splits[node - 1] is None:
            return below(2 * node, level + 1)
        name, at = splits[node - 1]
        return F.when(columns[name] >= at, below(2 * node + 1, level + 1)).otherwise(below(2 * node, level + 1))

    return below(1, 0)


def _value(columns: dict[str, Column], splits: Sequence[tuple[str, float] | None], leaves: Sequence[float]) -> Column:
    def below(node: int) -> Column:
        if node > len(splits):
            return F.lit(float(leaves[node - len(splits) - 1]))
        if splits[node - 1] is None:
            return below(2 * node)
        name, at = splits[node - 1]
        return F.when(columns[name] >= at, below(2 * node + 1)).otherwise(below(2 * node))

    return below(1)


def log_odds(columns: dict[str, Column], trees: Trees) -> Column:
    out = F.lit(trees.base[0])
    for splits, leaves in zip(trees.splits, trees.leaves, strict=True):
        out = out + _value(columns, splits, leaves)
    return out


def rate_of(host: Column, trees: Trees) -> Column:
    if not trees.rates:
        return F.lit(trees.base[1])
    table = F.create_map(*[F.lit(x) for pair in trees.rates for x in pair])
    return F.coalesce(F.try_element_at(table, suffix(host)), F.lit(trees.base[1]))


def with_suffix_rate(rows: DataFrame, trees: Trees) -> DataFrame:
    """Rows with the ``suffix_rate`` of their ``host``, the overall one where no labelled row has the suffix."""
    joined = rows.withColumn("suffix", suffix(F.col("host"))).join(trees.suffixes, "suffix", "left").drop("suffix")
    return joined.withColumn("suffix_rate", F.coalesce("suffix_rate", F.lit(trees.base[1])))


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Trees from ``url``, ``host``, ``path``, ``label`` (1: block), on at most ``sample_rows`` different URLs in hash order.

    Half of them are of each label, where there are enough; each weighs as many rows as it has, scaled so that the sample has as
    many rows of its label as all. Suffix rates and the overall rate are of all rows.
    With one class or no rows there is nothing to split on: every URL gets that class (allow where there are no rows).
    """
    import math

    urls = materialize(labelled.groupBy("url", "host", "path", "label").agg(F.count("*").alias("n")), "url-labels")
    totals = {r["label"]: (r["urls"], r["n"]) for r in urls.groupBy("label").agg(F.count("*").alias("urls"), F.sum("n").alias("n")).collect()}
    n, positive = sum(t[1] for t in totals.values()), totals.get(1, (0, 0))[1]
    share = (positive + SMOOTH * 0.5) / (n + SMOOTH) if n else 0.0
    odds = math.log(share / (1 - share)) if n else -1.0
    counted = urls.groupBy(suffix(F.col("host")).alias("suffix")).agg(F.sum("n").alias("c"), F.sum(F.col("n") * F.col("label")).alias("p"))
    counted = materialize(counted.select("suffix", "c", ((F.col("p") + 10 * share) / (F.col("c") + 10)).alias("suffix_rate")), "url-suffixes")
    rates = tuple((r["suffix"], r["suffix_rate"]) for r in counted.orderBy(F.desc("c"), "suffix").limit(SUFFIXES).collect())
    empty = Trees((), (), rates, (odds, share), counted.select("suffix", "suffix_rate"))
    if not 0 < positive < n:
        return empty
    half = max(1, sample_rows // 2)
    room = {label: max(half, sample_rows - totals[1 - label][0]) for label in (0, 1)}
    drawn = [urls.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(room[label]) for label in (0, 1)]
    sample = materialize(drawn[0].unionByName(drawn[1]), "url-sample")
    got = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    scale = F.when(F.col("label") == 1, totals[1][1] / got[1]).otherwise(totals[0][1] / got[0])
    sample = with_suffix_rate(sample.withColumn("n", F.col("n") * scale), empty)
    columns = features(F.col("url"), F.col("host"), F.col("path"), F.col("suffix_rate"))
    names = list(columns)
    values = sample.select("label", "n", *[c.cast("double").alias(name) for name, c in columns.items()])
    data = materialize(values.groupBy("label", *names).agg(F.sum("n").alias("n")).coalesce(1), "url-features")
    cuts = data.agg(*[F.percentile_approx(name, [i / bins for i in range(1, bins)], F.lit(1000), ).alias(name) for name in names]).first()
    edges = {name: sorted(set(cuts[name])) for name in names}
    here = {name: F.col(name) for name in names}
    binned = [
        F.struct(F.lit(f).alias("f"), sum((F.when(F.col(name) >= e, 1).otherwise(0) for e in edges[name]), F.lit(0)).alias("bin"))
        for f, name in enumerate(names)
    ]
    grown: Trees = empty
    for _ in range(trees):
        splits: list[tuple[str, float] | None] = [None] * (2**depth - 1)
        p = 1 / (1 + F.exp(-log_odds(here, grown)))
        weights: dict[int, tuple[float, float]] = {}
        for level in range(depth):
            leaf = _node(here, splits, level)
            rows = data.select(leaf.alias("leaf"), ((F.col("label") - p) * F.col("n")).alias("g"), (p * (1 - p) * F.col("n")).alias("h"), F.explode(F.array(*binned)).alias("x"))
            sums = rows.groupBy("leaf", "x.f", "x.bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            weights = _split(sums, splits, names, edges, weights)
        leaves = tuple(RATE * g / (h + SMOOTH) for g, h in (weights.get(node, (0.0, 0.0)) for node in range(2**depth, 2 ** (depth + 1))))
        grown = Trees((*grown.splits, tuple(splits)), (*grown.leaves, leaves), rates, grown.base, grown.suffixes)
    return grown


def _split(sums: list, splits: list, names: list[str], edges: dict[str, list[float]], weights: dict) -> dict[int, tuple[float, float]]:
    """Set the best split of every leaf of a level; the sums of both sides by node."""
    out: dict[int, tuple[float, float]] = {}
    for leaf in sorted({r["leaf"] for r in sums}):
        best = (1e-6, None, None)
        total = (0.0, 0.0)
        for f, name in enumerate(names):
            by_bin = {r["bin"]: (r["g"], r["h"]) for r in sums if r["leaf"] == leaf and r["f"] == f}
            g, h = (sum(x[i] for x in by_bin.values()) for i in (0, 1))
            total = (g, h)
            right_g, right_h = g, h
            for i, edge in enumerate(edges[name]):
                right_g, right_h = right_g - by_bin.get(i, (0, 0))[0], right_h - by_bin.get(i, (0, 0))[1]
                gain = right_g**2 / (right_h + SMOOTH) + (g - right_g) ** 2 / (h - right_h + SMOOTH) - g**2 / (h + SMOOTH)
                if gain > best[0]:
                    best = (gain, (name, edge), (right_g, right_h))
        splits[leaf - 1] = best[1]
        if best[1] is None:
            out[2 * leaf] = total
        else:
            out[2 * leaf + 1] = best[2]
            out[2 * leaf] = (total[0] - best[2][0], total[1] - best[2][1])
    return out


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """key, host, path, rule, verdict, block_score of every row.

    The verdict is the fitting rule's; where none fits it is the trees', ``block`` from a score of 0.5. A null or malformed
    URL has an empty host and path, fits no rule and is scored like any other. Repeated rows stay; other columns are
    ignored; an empty table stays empty.
    """
    host, path = parts(F.col(url))
    rows = pages.select(F.col(key), F.col(url).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    labelled = rows.where(F.col("fit").isNotNull()).select("url", "host", "path", (F.col("fit.verdict") == "block").cast("int").alias("label"))
    trees = fit(labelled, sample_rows)
    columns = features(F.col("url"), F.col("host"), F.col("path"), F.col("suffix_rate"))
    valued = with_suffix_rate(rows, trees).select(key, "host", "path", "fit", *[c.cast("double").alias(f"f_{name}") for name, c in columns.items()])
    score = 1 / (1 + F.exp(-log_odds({name: F.col(f"f_{name}") for name in columns}, trees)))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(score >= 0.5, "block").otherwise("allow"))
    return valued.select(key, "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), score.alias("block_score"))
