"""URL filters: rules for hosts and paths, and a character language-model ratio for the rest.

Two variable-order Markov models, one of accepted and one of rejected URLs, learn from the URLs the
rules decide.  An order's estimate is smoothed with the next shorter one's.  Counts are exact: the
table of distinct ``ORDER``-grams grows with the corpus and stays in Spark; a place in a URL is worth
what its gram is worth: grams of all orders are counted in one pass, valued by windows over their
contexts and over their ends, and URLs add up their grams.  A URL is judged by its log-likelihood difference per character.  The threshold comes from a
fifth of the decided URLs under a model of the others; the judging model counts all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwell.llm.common import text_slices
from tierwell.sources.shared import stored

#: (verdict, host, path).  A rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 5
PRIOR = 4.0
ALPHABET = 256
BINS = 2000
REACH = 4.0
#: Log ratios are added up as whole multiples of 1 / UNIT, in any order alike.
UNIT = 1e9


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as ``host/path`` text and its verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [_fits(host, path, h, p) for _, h, p in ordered]
    name = F.coalesce(*[F.when(fit, F.lit(h + p)) for fit, (_, h, p) in zip(fits, ordered, strict=True)], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(fit, F.lit(v)) for fit, (v, _, _) in zip(fits, ordered, strict=True)], F.lit(None).cast("string"))
    return name, verdict


def _bin(score: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((score + REACH) / (2 * REACH / BINS)))).cast("int")


def _balance(held: np.ndarray) -> float:
    """The threshold at which the error shares of both sides (rejected, accepted; a column a bin) add up
    to the least; 0 without rows on a side."""
    if not held.sum(axis=1).all():
        return 0.0
    lost = np.concatenate(([0.0], np.cumsum(held[1]))) / held[1].sum()
    passed = 1.0 - np.concatenate(([0.0], np.cumsum(held[0]))) / held[0].sum()
    error = lost + passed
    best = np.flatnonzero(error <= error.min() + 1e-12)
    return float(-REACH + 2 * REACH / BINS * (best[0] + best[-1]) / 2)


def grams(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) of each character: it and the ORDER - 1 bytes before, as one number, oldest first."""
    raw = [b"\0" * (ORDER - 1) + t.encode("utf-8", "surrogatepass") + b"\0" for t in texts]
    codes = np.frombuffer(b"".join(raw), dtype=np.uint8)
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    rows = np.repeat(np.arange(len(raw)), sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
    at = np.flatnonzero(np.arange(len(codes)) - starts[rows] >= ORDER - 1)
    key = np.zeros(len(at), dtype=np.int64)
    for k in range(ORDER - 1, -1, -1):
        key = (key << 8) | codes[at - k]
    return rows[at], key


#: Bodies by how they count: rejected and accepted ones, those of the held-out fifth apart, and those without a verdict.
ASKED = 4
#: Counts of the rejected and accepted URLs, outside the held-out fifth and altogether.
_SUMS = {f"learned{y}": (2 * y,) for y in (0, 1)} | {f"all{y}": (2 * y, 2 * y + 1) for y in (0, 1)}


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of all orders; a shorter one is the end of a longer one, so its counts are sums of theirs."""
    for batch in batches:
        kind, weight = (np.asarray(batch.column(c), dtype=np.int64) for c in ("kind", "n"))
        for start, texts in text_slices(batch.column("body")):
            rows, key = grams(texts)
            own, n = key * 8 + kind[start + rows], weight[start + rows]
            for size in range(ORDER, 0, -1):
                own, place = np.unique(own & ((1 << 8 * size + 3) - 1), return_inverse=True)
                total = np.zeros(len(own), dtype=np.int64)
                np.add.at(total, place, n)
                n = total
                sizes = np.full(len(own), size, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(sizes), pa.array(own >> 3), pa.array((own & 7).astype("<i4")), pa.array(n)], names=["size", "gram", "kind", "n"])


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uids = np.asarray(batch.column("uid"))
        for start, texts in text_slices(batch.column("body")):
            rows, key = grams(texts)
            yield pa.RecordBatch.from_arrays([pa.array(uids[start + rows]), pa.array(key)], names=["uid", "gram"])


def gram_tallies(bodies: DataFrame) -> DataFrame:
    """size, gram, _SUMS and ``of_`` _SUMS (of all grams with its context) of the grams of all orders that a
    body whose kind is not learned holds, for ``bodies`` (body, kind, n)."""
    found = bodies.select("body", "kind", "n").mapInArrow(_gram_counts, "size int, gram long, kind int, n long")
    sums = [F.sum(F.when(F.col("kind").isin(*kinds), F.col("n")).otherwise(0)).alias(c) for c, kinds in _SUMS.items()]
    follow = found.groupBy("size", "gram").agg(*sums, F.max(F.col("kind").isin(1, 3, ASKED)).alias("asked"))
    context = Window.partitionBy("size", F.shiftright("gram", 8))  # 256 rows at most
    return follow.select("*", *[F.sum(c).over(context).alias(f"of_{c}") for c in _SUMS]).where("asked").drop("asked")


def _end(size: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1)).cast("long")


def gram_values(tallies: DataFrame) -> DataFrame:
    """gram, learned, every: log P(accepted) - log P(rejected) in units of 1 / UNIT of each gram of ORDER
    characters of ``tallies``, under the models of its counts.

    Estimates of one and two characters (65,792 at most) are broadcast.  Longer grams with the same last
    three lie together, 65,793 at most, so that one shuffle brings each the estimates of its ends."""

    def smoothed(c: str, prior: Column) -> Column:
        return (F.col(c) + PRIOR * prior) / (F.col(f"of_{c}") + PRIOR)

    one = tallies.where("size = 1").select(F.col("gram").alias("end"), *[smoothed(c, F.lit(1.0 / ALPHABET)).alias(f"q_{c}") for c in _SUMS])
    two = tallies.where("size = 2").withColumn("end", _end(1)).join(F.broadcast(one), "end")
    two = two.select(F.col("gram").alias("end"), *[smoothed(c, F.col(f"q_{c}")).alias(f"q_{c}") for c in _SUMS])
    rows = tallies.where("size > 2").withColumn("end", _end(2)).join(F.broadcast(two), "end").drop("end")
    ends: list[str] = []
    for size in range(3, ORDER):
        # Shorter grams are done; null keeps them apart from those of this length.
        ends.append(f"end{size}")
        rows = rows.withColumn(ends[-1], F.when(F.col("size") >= size, _end(size)))
        at = Window.partitionBy(*ends)
        rows = rows.withColumns({f"q_{c}": F.max(F.when(F.col("size") == size, smoothed(c, F.col(f"q_{c}")))).over(at) for c in _SUMS})
    p = rows.where(F.col("size") == ORDER).select("gram", *[smoothed(c, F.col(f"q_{c}")).alias(f"p_{c}") for c in _SUMS])
    ratio = {name: F.round((F.log(f"p_{name}1") - F.log(f"p_{name}0")) * UNIT).cast("long") for name in ("learned", "all")}
    return p.select("gram", ratio["learned"].alias("learned"), ratio["all"].alias("every"))


def scored_bodies(bodies: DataFrame) -> tuple[DataFrame, float]:
    """(body, score) of the bodies without a verdict, and the threshold, for ``bodies`` (uid, body, verdict, n)."""
    held = (F.crc32("body") % 5 == 0).cast("int")
    kinds = bodies.withColumn("kind", F.coalesce((F.col("verdict") == "allow").cast("int") * 2 + held, F.lit(ASKED)))
    values = gram_values(stored(gram_tallies(kinds), "url-grams"))
    asked = kinds.where(F.col("kind").isin(1, 3, ASKED))
    places = asked.select("uid", "body").mapInArrow(_gram_rows, "uid long, gram long")
    # All places are valued.  A left join never broadcasts them, whose size Spark takes for that of the bodies.
    total = places.join(values, "gram", "left").groupBy("uid").agg(F.count("*").alias("places"), *[F.sum(c).alias(c) for c in ("learned", "every")])
    scored = stored(asked.join(total, "uid").select("body", "kind", "n", *[(F.col(c) / UNIT / F.col("places")).alias(c) for c in ("learned", "every")]), "url-scores")
    found = np.zeros((2, BINS))
    for r in scored.where(F.col("kind") != ASKED).groupBy("kind", _bin(F.col("learned")).alias("bin")).agg(F.sum("n").alias("n")).collect():
        found[r["kind"] // 2, r["bin"]] = r["n"]
    return scored.where(F.col("kind") == ASKED).select("body", F.col("every").alias("score")), _balance(found)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of ``pages`` (page_id, url).

    A null url or one without ``://`` has an empty host and path, which no rule fits.  The method learns
    and judges the whole url, its scheme, query and fragment too; null is an empty text.  The method's score is null where a rule decides.  If the rules decide
    nothing, all scores are 0 and the method allows.  Repeated rows each get their row and count
    each; a tie with the threshold is allowed.  Further columns are not looked at."""
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.coalesce("url", F.lit("")).alias("body"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), "body")
    counted = ruled.groupBy("body", "ruled").agg(F.count("*").alias("n")).select("body", F.col("ruled").alias("verdict"), "n")
    bodies = stored(counted.withColumn("uid", F.monotonically_increasing_id()), "url-bodies")
    scores, threshold = scored_bodies(bodies)
    judged = scores.withColumnRenamed("body", "_b")
    decided = ruled.where(F.col("ruled").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    rows = decided.unionByName(ruled.where(F.col("ruled").isNull()).join(judged, F.col("body") == F.col("_b")).drop("_b"))
    own = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")
