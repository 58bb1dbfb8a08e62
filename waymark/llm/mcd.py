"""Quality rules: multivariate outliers by minimum-covariance-determinant estimates, in DataFrame operations only.

Each text gets counts (words, symbols, repeated lines, repeated word windows) and, from them, a vector of five
transformed statistics in whole ten-thousandths. For each language and source, for each language, and for all
texts, location and scatter are estimated from the texts that pass the base rules:

* starts: medians with quartile ranges, means with covariances, and spatial signs about the medians;
* from each, STEPS concentration steps: the SHARE of texts with the least distances, found from counts of distance
  bins, gives the next mean and covariance, whose determinant falls;
* of all starts and steps the smallest determinant wins; its covariance is scaled by the consistency factor of SHARE;
* a source's mean and covariance are drawn towards its language's, and a language's towards those of all texts,
  as if the latter had been seen in PRIOR texts, so that small groups need no rule of their own;
* a text is rejected if its squared Mahalanobis distance for its language and source is above LIMIT.

FLOORS are added to the variances as a ridge, since statistics such as symbol shares are zero in most texts; the
determinant is that of the sum. Sums are over whole numbers in decimals, so the result depends neither on
partitions nor on the order of rows. All group sums and counts are aggregated partially, and estimates are
broadcast to the texts after their number is checked (beyond MOST_GROUPS they are joined, with groups salted), so
that no group's texts are gathered.

Null texts count as empty: no words, base_failed, not kept. Null languages and sources are groups of their own.
Repeated rows and null ids give a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.common import written

SHARE, STEPS, PRIOR = 0.75, 4, 50
#: Groups and starts whose estimates are broadcast, at less than 400 bytes each, and pieces of a group beyond that.
MOST_GROUPS, PIECES = 100_000, 32
SCALE = 10_000
STATISTICS = ("size", "word_length", "symbols", "repeated_lines", "repeated_words")
#: Standard deviations added in quadrature, in the statistics' units.
FLOORS = (0.3, 0.05, 0.15, 0.25, 0.25)
D = len(STATISTICS)
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[ \t\n\x0B\f\r]+"
#: Distance bins per factor of two, and whole values in a bin for quartiles.
BINS, VALUES = 64, 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _lower_gamma(a: float, x: float) -> float:
    """The regularised lower incomplete gamma function."""
    if x <= 0:
        return 0.0
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > 1e-17 * abs(total):
            k += 1
            term *= x / k
            total += term
        return total * math.exp(a * math.log(x) - x - math.lgamma(a))
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for k in range(1, 500):
        an = -k * (k - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1 - math.exp(a * math.log(x) - x - math.lgamma(a)) * h


def chi_squared_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _lower_gamma(degrees / 2, middle / 2) < p else (low, middle)
    return high


def consistency(share: float, degrees: int) -> float:
    """What the covariance of the nearest share of a normal sample is multiplied by."""
    return share / _lower_gamma(degrees / 2 + 1, chi_squared_quantile(share, degrees) / 2)


#: Largest squared distance of a text that is kept: far beyond QUANTILE of a normal sample (TAILS times its
#: distance), since texts' statistics have longer tails than that and clean texts must stay.
QUANTILE, TAILS = 0.999, 5.0
LIMIT = TAILS * chi_squared_quantile(QUANTILE, D)


def with_counts(docs: DataFrame) -> DataFrame:
    """The documents with COUNTS, n_lines and base_failed; other columns stay. Names with two underscores are scratch."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    own = docs.select("*", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES)).alias("w__"), F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]")).alias("l__"))
    own = own.withColumn("b__", F.ceil(F.log2(F.size("w__") + 1)).cast("int"))  # bits of a window's place; its hash has the others
    grams = F.expr(
        "case when size(w__) > 2 then sort_array(transform(sequence(0, size(w__) - 3), i -> (shiftleft(shiftright(xxhash64(get(w__, i), get(w__, i + 1), get(w__, i + 2)), b__), b__) | cast(i as bigint))))"
        " else array(cast(null as bigint)) end"
    )
    own = own.select("*", grams.alias("g__"), F.expr("shiftleft(1L, b__) - 1").alias("m__"))
    at = lambda k: f"cast(get(g__, {k}) & m__ as int)"
    same = lambda k: f"(shiftright(x, b__) = shiftright(get(g__, {k}), b__) and " + " and ".join(f"get(w__, cast(x & m__ as int) + {j}) = get(w__, {at(k)} + {j})" for j in range(3)) + ")"
    twice = f"filter(g__, (x, k) -> (k > 0 and {same('k - 1')}) or (k < size(g__) - 1 and {same('k + 1')}))"
    covered = f"aggregate(sort_array(transform({twice}, x -> x & m__)), struct(0L as n, -3L as last), (a, p) -> struct(a.n + least(3L, p - a.last) as n, p as last), a -> a.n)"
    words = F.size("w__").cast("long")
    own = own.select(
        *docs.columns,
        words.alias("n_words"),
        F.length(F.regexp_replace(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("l__") - F.size(F.array_distinct("l__"))).cast("long").alias("n_dup_lines"),
        F.when(words > 2, F.expr(covered)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("l__").cast("long").alias("n_lines"),
    )
    return own.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def statistics() -> list[Column]:
    """The transformed statistics of a text that passes the base rules, null for others."""
    ratio = lambda a, b: F.col(a).cast("double") / F.col(b).cast("double")
    of = [F.log1p(F.col("n_words").cast("double")), F.log(ratio("word_chars", "n_words")), F.log1p(100 * ratio("n_symbols", "word_chars")), F.log1p(10 * ratio("n_dup_lines", "n_lines")), F.log1p(10 * ratio("n_repeat_words", "n_words"))]
    return [F.when(~F.col("base_failed"), F.round(SCALE * value).cast("long")).alias(f"z{k}") for k, value in enumerate(of)]


def group_names() -> list[Column]:
    """Language and source, language, all; each part is written with its length, so that no two groups share a name."""
    part = lambda c: F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)))
    return [F.concat(F.lit("s|"), part("lang"), F.lit("|"), part("source")), F.concat(F.lit("l|"), part("lang")), F.lit("a")]


def _sum(terms: list[str]) -> str:
    return "(" + " + ".join(terms) + ")"


MEANS = [f"m{k}" for k in range(D)]
ENTRIES = [(i, j) for i in range(D) for j in range(i + 1)]
COVARIANCES = [f"c{i}_{j}" for i, j in ENTRIES]
PRODUCTS = [f"p{i}_{j}" for i, j in ENTRIES]


#: Squared Mahalanobis distance from the columns z*, m* and p*_*. Expressions of many terms are SQL text, which is planned much faster than columns put together one by one.
DISTANCE = _sum([f"{1 if i == j else 2}D * p{i}_{j} * (z{i} - m{i}) * (z{j} - m{j})" for i, j in ENTRIES])


def _inverse_terms() -> list[str]:
    """The Cholesky factor t*_* of covariance and floors, row by row, its inverse v*_*, the product p*_*, and logdet."""
    ridge = lambda i, j: f"{(FLOORS[i] * SCALE) ** 2!r}D" if i == j else "0D"
    out = []
    for i in range(D):
        for j in range(i + 1):
            rest = f"(c{i}_{j} + {ridge(i, j)}" + "".join(f" - t{i}_{k} * t{j}_{k}" for k in range(j)) + ")"
            out.append(f"sqrt{rest} as t{i}_{j}" if i == j else f"{rest} / t{j}_{j} as t{i}_{j}")
    for j in range(D):
        out.append(f"1D / t{j}_{j} as v{j}_{j}")
        out += [f"-{_sum([f't{i}_{k} * v{k}_{j}' for k in range(j, i)])} / t{i}_{i} as v{i}_{j}" for i in range(j + 1, D)]
    out += [f"{_sum([f'v{k}_{i} * v{k}_{j}' for k in range(i, D)])} as p{i}_{j}" for i, j in ENTRIES]
    return [*out, f"2D * {_sum([f'ln(t{i}_{i})' for i in range(D)])} as logdet"]


def _inverted(moments: DataFrame) -> DataFrame:
    """The rows with the inverse p*_* of covariance c*_* plus the floors, and logdet, the logarithm of its determinant."""
    return moments.selectExpr("*", *_inverse_terms()).select(*moments.columns, *PRODUCTS, "logdet")


def _few(estimates: DataFrame) -> bool:
    return estimates.count() <= MOST_GROUPS


def _attached(rows: DataFrame, estimates: DataFrame, few: bool) -> DataFrame:
    """Rows with grp, joined with what is known of their groups: broadcast if few, else by pieces of a group."""
    if few:
        return rows.join(F.broadcast(estimates), "grp")
    salted = rows.withColumn("piece__", F.pmod(F.xxhash64(*(f"z{k}" for k in range(D))), F.lit(PIECES)))
    return salted.join(estimates.withColumn("piece__", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PIECES - 1).cast("long")))), ["grp", "piece__"]).drop("piece__")


def _moments(chosen: DataFrame, *by: str) -> DataFrame:
    """k, means and covariances of the z*, from exact sums."""
    exact = lambda what, name: F.expr(f"sum(cast({what} as decimal(38,0))) as {name}")
    sums = chosen.groupBy(*by).agg(F.expr("count(1) as k"), *(exact(f"z{i}", f"s{i}") for i in range(D)), *(exact(f"z{i} * z{j}", f"q{i}_{j}") for i, j in ENTRIES))
    return sums.selectExpr(*by, "k", *(f"cast(s{i} as double) / k as m{i}" for i in range(D)), *(f"cast(q{i}_{j} * k - s{i} * s{j} as double) / (cast(k as double) * cast(k as double)) as c{i}_{j}" for i, j in ENTRIES))


def leveled(vectors: DataFrame) -> DataFrame:
    """Each vector once for each of its groups."""
    return vectors.select(F.explode("groups").alias("grp"), *(f"z{k}" for k in range(D)))


def _quartiles(vectors: DataFrame) -> DataFrame:
    """grp, n, medians as m*, and the standard deviations sd* that the quartile ranges stand for, from counts of binned values."""
    values = leveled(vectors).select("grp", F.posexplode(F.array(*(F.floor(F.col(f"z{k}") / VALUES) for k in range(D)))).alias("k", "z"))
    counted = values.groupBy("grp", "k", "z").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy("grp", "k").orderBy("z")  # of a bounded number of bins
    ranked = counted.select("grp", "k", "z", F.sum("c").over(upto).alias("upto"), F.sum("c").over(Window.partitionBy("grp", "k")).alias("n"))
    quantile = lambda p: (F.min(F.when(F.col("upto") >= p * F.col("n"), F.col("z"))) * VALUES + VALUES // 2).cast("double")
    found = ranked.groupBy("grp", "k").agg(F.first("n").alias("n"), quantile(0.5).alias("m"), ((quantile(0.75) - quantile(0.25)) / 1.349).alias("sd"))
    at = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    return found.groupBy("grp").agg(F.max("n").alias("n"), *(at(k, "m").alias(f"m{k}") for k in range(D)), *(at(k, "sd").alias(f"sd{k}") for k in range(D)))


def starts(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """grp, start, n, m*, c*_* of the three starts of each group."""
    quartiles = written(spark, _quartiles(vectors), "mcd-quartiles")
    ridge = [f"{(FLOORS[i] * SCALE) ** 2!r}D" for i in range(D)]
    medians = quartiles.selectExpr("grp", "0 as start", "n", *MEANS, *(f"{f'sd{i} * sd{i}' if i == j else '0D'} as c{i}_{j}" for i, j in ENTRIES))
    means = _moments(leveled(vectors), "grp").selectExpr("grp", "1 as start", "k as n", *MEANS, *COVARIANCES)
    scaled = quartiles.selectExpr("grp", "n", *MEANS, *(f"sqrt(sd{i} * sd{i} + {ridge[i]}) as w{i}" for i in range(D)))
    own = _attached(leveled(vectors), scaled, _few(quartiles)).selectExpr("grp", *(f"(z{i} - m{i}) / w{i} as u{i}" for i in range(D)))
    length = f"greatest(sqrt{_sum([f'u{i} * u{i}' for i in range(D)])}, 1e-9D)"
    turned = _moments(own.selectExpr("grp", *(f"cast(round({SCALE} * u{i} / {length}) as bigint) as z{i}" for i in range(D))), "grp").drop("k", *MEANS).join(scaled, "grp")
    signs = turned.selectExpr("grp", "2 as start", "n", *MEANS, *(f"c{i}_{j} * {D / SCALE**2!r}D * w{i} * w{j} as c{i}_{j}" for i, j in ENTRIES))
    return medians.unionByName(means).unionByName(signs)


def _step(spark: SparkSession, vectors: DataFrame, current: DataFrame, few: bool) -> DataFrame:
    """One concentration step: grp, start, n, m*, c*_*, p*_*, logdet from the least distance bins that hold SHARE of a group."""
    binned = lambda known: _attached(leveled(vectors), known, few).selectExpr("*", f"cast(floor(log2(greatest({DISTANCE}, 1e-9D)) * {BINS}) as bigint) as bin")
    known = ["grp", "start", "n", *MEANS, *PRODUCTS]
    counted = binned(current.select(*known)).groupBy("grp", "start", "n", "bin").agg(F.count(F.lit(1)).alias("c"))
    upto = counted.select("grp", "start", "n", "bin", F.sum("c").over(Window.partitionBy("grp", "start").orderBy("bin")).alias("upto"))  # of a bounded number of bins
    last = upto.where(F.col("upto") >= SHARE * F.col("n")).groupBy("grp", "start").agg(F.min("bin").alias("last"))
    near = binned(last.join(current.select(*known), ["grp", "start"])).where("bin <= last")
    return written(spark, _inverted(_moments(near, "grp", "start", "n").drop("k")), "mcd-step")


def estimates(spark: SparkSession, counted: DataFrame) -> DataFrame:
    """grp, n, start, m*, c*_*, logdet of the best estimate of every group that has texts past the base rules, before it is drawn to a larger one."""
    return concentrated(spark, written(spark, counted.select(F.array(*group_names()).alias("groups"), *statistics()).where("z0 is not null"), "mcd-vectors"))


def concentrated(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    """The same of vectors z* with their groups."""
    current = written(spark, _inverted(starts(spark, vectors)), "mcd-starts")
    few, found = _few(current), None
    for _ in range(STEPS):
        current = _step(spark, vectors, current, few)
        found = current if found is None else found.unionByName(current)
    best = found.groupBy("grp").agg(F.min(F.struct("logdet", "start", "n", *MEANS, *COVARIANCES)).alias("e"))
    return written(spark, best.select("grp", "e.n", "e.start", *(f"e.{c}" for c in (*MEANS, *COVARIANCES)), "e.logdet"), "mcd-best")


def drawn(spark: SparkSession, counted: DataFrame, found: DataFrame) -> DataFrame:
    """grp, m*, p*_* of languages and sources: scaled for consistency and drawn towards the larger group."""
    factor = consistency(SHARE, D)
    own = found.selectExpr("grp", "n", *MEANS, *(f"{factor!r}D * {c} as {c}" for c in COVARIANCES))
    above = own.where("grp = 'a'").selectExpr("'a' as above", *(f"{c} as {c}__" for c in (*MEANS, *COVARIANCES)))
    fine, middle, _ = group_names()
    families = counted.where("not base_failed").select(fine.alias("fine"), middle.alias("middle")).distinct()
    parents = families.select(F.col("middle").alias("grp"), F.lit("a").alias("above")).distinct(), families.select(F.col("fine").alias("grp"), F.col("middle").alias("above"))
    for parent in parents:
        level = own.join(parent, "grp").join(above, "above").selectExpr("grp", *(f"(n * {c} + {PRIOR} * {c}__) / (n + {PRIOR}) as {c}" for c in (*MEANS, *COVARIANCES)))
        above = level.selectExpr("grp as above", *(f"{c} as {c}__" for c in (*MEANS, *COVARIANCES)))
    return written(spark, _inverted(level).select("grp", *MEANS, *PRODUCTS), "mcd-final")


def judge(counted: DataFrame, final: DataFrame) -> DataFrame:
    """The counted rows with distance and kept."""
    names = {name: f"row__.c{k}" for k, name in enumerate(counted.columns)}
    own = counted.select(F.struct(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(counted.columns))).alias("row__"), group_names()[0].alias("grp"), *statistics())
    passed, failed = own.where("z0 is not null"), own.where("z0 is null")
    near = _attached(passed, final, _few(final)).selectExpr("row__", f"{DISTANCE} as distance")
    rows = near.unionByName(failed.select("row__", F.lit(None).cast("double").alias("distance")))
    return rows.select(*(F.col(at).alias(name) for name, at in names.items()), "distance", F.coalesce(F.col("distance") <= LIMIT, F.lit(False)).alias("kept"))


def quality_verdicts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, COUNTS, base_failed, kept, squared distance."""
    counted = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source"))
    counted = written(spark, counted.drop("text"), "mcd-counts")
    final = drawn(spark, counted, estimates(spark, counted))
    return judge(counted, final).select("doc_id", *COUNTS, "base_failed", "kept", F.round("distance", 6).alias("distance"))


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns as they were; rows are written once with their counts."""
    fields = F.struct(*(F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(docs.columns)))
    counted = written(spark, with_counts(docs.select(fields.alias("row"), "text", "lang", "source")).drop("text"), "mcd-counts")
    small = counted.drop("row")
    kept = judge(counted, drawn(spark, small, estimates(spark, small))).where("kept")
    return kept.select(*(F.col(f"row.c{k}").alias(f"{name}") for k, name in enumerate(docs.columns)))
