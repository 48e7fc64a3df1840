"""URL filter: rules first, else logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import ascii_lower, without

GRAM = 3
BUCKETS = 4096
STEPS = 300
RATE = 2.0
DECAY = 0.002
LABELLED_BOUND = 10_000

# verdict, host, path; a rule holds for its host and all subdomains.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# The labelled table the classifier learns from: 1 block, 0 allow.
LABELLED = (
    ("https://casino-win.example.com/en/12", 1),
    ("http://www.casino-royal.example.net/bonus", 1),
    ("https://best-casino.example.org/en/77.html", 1),
    ("https://cheap-pills.example.com/en/31", 1),
    ("http://m.cheap-pills.example.net/de/5", 1),
    ("https://pills-online.example.com/buy", 1),
    ("https://free-bets.example.com/en/64", 1),
    ("http://blog.free-bets.example.net/fr/8", 1),
    ("https://bets-today.example.org/odds", 1),
    ("https://ads-track.example.com/en/584", 1),
    ("http://ads-track.example.org/click?id=3", 1),
    ("https://track-ads.example.net/pixel", 1),
    ("https://spam-farm.example.org/en/728", 1),
    ("http://www.spam-farm.example.net/es/4", 1),
    ("https://link-farm.example.com/en/9/", 1),
    ("http://xxx-cams.example.com/live", 1),
    ("https://adult-cams.example.net/en/2", 1),
    ("https://quick-loans.example.com/apply", 1),
    ("http://free-loans.example.net/en/90", 1),
    ("https://win-prize.example.com/claim", 1),
    ("https://replica-watches.example.com/shop", 1),
    ("https://therin.example.net/en/770", 0),
    ("https://www.ththen.example.com/en/148.html", 0),
    ("https://blog.tiontion.example.com/en/853/", 0),
    ("http://m.ththth.example.net/en/25", 0),
    ("https://blog.thernd.example.net/de/612", 0),
    ("http://therat.example.net/en/231", 0),
    ("https://ththan.example.net/fr/8423", 0),
    ("https://tionsh.example.net/en/21835", 0),
    ("https://blog.ththea.example.net/de/38211", 0),
    ("http://m.theres.example.net/es/17872", 0),
    ("https://www.therea.example.com/es/402", 0),
    ("https://ththre.example.com/fr/825", 0),
    ("https://news.example.com/en/2021/04/budget", 0),
    ("https://www.university.example.net/en/courses", 0),
    ("https://docs.example.com/en/guide.html", 0),
    ("https://library.example.net/fr/catalogue", 0),
    ("https://museum.example.com/de/kunst", 0),
    ("https://blog.garden.example.net/en/roses", 0),
    ("https://weather.example.com/es/norte", 0),
    ("https://recipes.example.net/en/bread.html", 0),
    ("https://www.history.example.com/en/rome/", 0),
)


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case."""
    rest = F.substring_index(_after(url), "/", 1)
    bare = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return ascii_lower(F.when(_has_scheme(url), bare).otherwise(F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    rest = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    at = F.instr(rest, "/")
    path = F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise(F.lit(""))
    return F.when(_has_scheme(url), path).otherwise(F.lit(""))


def _has_scheme(url: Column) -> Column:
    return F.coalesce(F.instr(url, "://") > 0, F.lit(False))


def _after(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(
            path, F.lit(start)
        )
        hit = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def _grams(text: Column, mark: str) -> Column:
    """Hash buckets of all n-grams of ``^text$``; character arrays keep this linear."""
    letters = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    starts = F.sequence(F.lit(0), F.greatest(F.size(letters) - GRAM, F.lit(0)))
    return F.transform(
        starts,
        lambda i: F.pmod(
            F.xxhash64(F.concat(F.lit(mark), F.array_join(F.slice(letters, i + 1, GRAM), ""))),
            F.lit(BUCKETS),
        ).cast("int"),
    )


def url_features(host: Column, path: Column) -> Column:
    return F.array_distinct(F.concat(_grams(host, "h"), _grams(path, "p")))


def train(labelled: DataFrame) -> list[float]:
    """Weights per bucket, the bias last, from ``labelled`` (url, label 0/1).

    Full-batch gradient descent written as one SQL expression over one row: the
    labelled table is small (``LABELLED_BOUND`` rows at most, else an error), so its
    features fit an array. Rows without label are ignored; null urls count as empty.
    """
    known = labelled.filter(F.col("label").isNotNull())
    rows = known.count()
    if rows > LABELLED_BOUND:
        raise ValueError(f"{rows} labelled urls; the bound is {LABELLED_BOUND}")
    if not rows:
        return [0.0] * (BUCKETS + 1)
    url = F.col("url")
    cases = known.select(
        F.struct(
            F.col("label").cast("double").alias("y"),
            url_features(url_host(url), url_path(url)).alias("x"),
        ).alias("case"),
    ).agg(F.sort_array(F.collect_list("case")).alias("cases"))
    # Buckets that occur, and for each the cases it occurs in.
    laid_out = cases.selectExpr(
        "cases", "sort_array(array_distinct(flatten(transform(cases, c -> c.x)))) as used"
    ).selectExpr(
        "transform(cases, c -> struct(c.y as y, transform(c.x, j -> "
        "cast(array_position(used, j) as int)) as x)) as cases",
        "used",
    )
    posted = laid_out.selectExpr(
        "cases",
        "used",
        "transform(sequence(1, size(used)), j -> filter(sequence(1, size(cases)), "
        "i -> array_contains(cases[i - 1].x, j))) as held",
    )
    step = f"""
      aggregate(sequence(1, {STEPS}),
        named_struct('w', transform(used, j -> 0D), 'b', 0D),
        (s, k) -> transform(array(transform(cases, c ->
            1D / (1D + exp(-(s.b + aggregate(c.x, 0D, (a, j) -> a + s.w[j - 1])))) - c.y)),
          e -> named_struct(
            'w', transform(held, (h, j) -> s.w[j] - {RATE}D * ({DECAY}D * s.w[j] +
                 aggregate(h, 0D, (a, i) -> a + e[i - 1]) / size(cases))),
            'b', s.b - {RATE}D * aggregate(e, 0D, (a, x) -> a + x) / size(cases)))[0])"""
    fitted = posted.selectExpr("used", f"{step} as s").selectExpr("used", "s.w as w", "s.b as b")
    row = fitted.first()
    weights = [0.0] * BUCKETS
    for bucket, weight in zip(row["used"], row["w"], strict=True):
        weights[bucket] = weight
    return [*weights, row["b"]]


def block_chance(features: Column, weights: Sequence[float]) -> Column:
    table = F.expr(f"array({','.join(f'{w!r}D' for w in weights[:BUCKETS])})")
    total = F.aggregate(features, F.lit(float(weights[-1])), lambda a, j: a + table[j])
    return 1.0 / (1.0 + F.exp(-total))


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url: str = "url",
) -> DataFrame:
    """Rows of ``pages`` with host, path, rule, verdict (allow or block) and block_chance.

    The longest rule that fits decides, else the classifier (block at 0.5 and over).
    A null url, or one without ``://``, has an empty host and path, fits no rule and
    is judged by the classifier. Columns of those names, in whatever case, are replaced. One narrow pass:
    no shuffle, weights travel as a literal of ``BUCKETS`` numbers.
    """
    weights = train(labelled)
    added = ("host", "path", "rule", "verdict", "block_chance")
    kept = without(pages, added).columns
    link = F.col(url)
    host, path = url_host(link), url_path(link)
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    scored = parts.withColumns(
        {
            "rule": matching_rule(F.col("host"), F.col("path"), rules),
            "block_chance": block_chance(url_features(F.col("host"), F.col("path")), weights),
        }
    )
    learnt = F.when(F.col("block_chance") >= 0.5, "block").otherwise("allow")
    return scored.select(
        *kept,
        "host",
        "path",
        F.col("rule.rule").alias("rule"),
        F.coalesce("rule.verdict", learnt).alias("verdict"),
        "block_chance",
    )


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LABELLED), "url string, label int")
