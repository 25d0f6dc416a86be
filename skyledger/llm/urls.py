"""URL filter: host/path rules first, then logistic regression on hashed
character n-grams of host and path. DataFrame functions only.

Defined results: a null url, or one without ``://``, has empty host and path;
it fits no rule and is judged by the model like any other text (its only
feature is the bias). Repeated rows are judged alike; an empty table gives no
rows. Only page_id and url are read, so extra columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the query: (verdict, host and path).
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]

#: The small labelled URL table (1 = block): a default that callers replace.
LABELLED = [(0, x) for x in (
    "https://www.cityuniversity.edu/departments/physics/courses", "https://en.encyclopedia.example.org/en/4411",
    "https://docs.projecthome.example.com/en/3029.html", "https://www.dailyherald.example.com/en/9120?page=2&ref=x",
    "https://library.statecollege.edu/catalog/item/48213", "https://blog.researchnotes.example.org/de/2019",
    "https://www.publichealth.gov/guidance/vaccines", "https://recipes.homekitchen.com/soup/tomato-basil",
    "http://m.museum.example.com/fr/613/", "https://forum.gardeners.org/t/pruning-roses/221",
    "https://www.weather.example.com/en/7721#top", "https://journal.sciencepress.org/article/10.1000/182",
    "https://thenother.example.com/es/5512.html", "https://learn.mathschool.example.org/en/1880",
    "https://m.newsroom.example.com/en/8841.html", "https://blog.travelstories.example.com/es/672",
    "http://onthere.example.org/en/118", "http://www.station.example.com/fr/9921?utm_source=feed",
    "https://blog.thisand.example.com/en/30411", "https://tionster.example.org/es/44/", "http://thethe.example.com/fr/10",
    "https://www.cooking.example.org/en/6112#top", "https://m.history.example.com/en/77512",
    "https://bletion.example.org/de/8?page=2&ref=x", "https://ththat.example.com/en/12", "http://blog.ththti.example.com/es/7",
    "https://m.ththes.example.org/en/931", "https://www.ththnd.example.com/fr/4", "http://ththou.example.org/es/66#top",
    "https://therly.example.com/en/5/", "https://blog.ththha.example.org/en/4077.html", "http://m.thernd.example.com/es/81",
    "https://tionsh.example.org/en/3", "https://www.thonth.example.com/en/15?page=2&ref=x", "https://therin.example.org/de/9",
    "https://tionst.example.com/fr/10", "http://ththre.example.org/en/2", "https://ththen.example.com/es/95")] + [(1, x) for x in (
    "http://casino-bonus.example.com/en/77", "http://best-casino-win.example.org/es/12.html",
    "http://cheap-meds.example.com/en/9921", "http://cheap-pills-online.biz/buy/viagra", "http://pills.example.org/fr/5",
    "http://xxx-videos.example.com/en/831", "http://adult-x-cams.example.org/es/4410", "http://adult-dating.xxx/signup/sex",
    "http://free-spins.example.com/en/55/", "http://free-bets-now.example.org/es/99", "http://online-bets.example.com/en/3",
    "http://win-prize.example.org/es/2031", "http://ads-click.example.com/en/4121", "http://ads-track-pixel.example.org/en/9",
    "http://track-user.example.com/es/77001", "http://spam-farm-links.example.com/en/14", "http://link-farm.example.org/en/81",
    "http://spam-seo.example.com/fr/2#top", "http://poker-bet.win/bonus/deposit", "http://torrent-free.cc/download/full",
    "http://replica-cheap.shop/rolex", "http://payday-loan.click/apply", "http://m.casino-slots.example.com/fr/40",
    "http://blog.cheap-pills.example.com/es/120?utm_source=feed", "https://spam-farm.example.com/en/1",
    "https://adult-x.example.org/es/2.html", "https://m.spam-farm.example.org/fr/31#top", "https://www.adult-x.example.com/en/8",
    "https://casino-win.example.com/es/61", "http://m.casino-win.example.org/en/5#top", "https://blog.spam-farm.example.com/es/3/", "https://www.ads-track.example.org/en/70/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # longest outermost
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def features(host: Column, path: Column, dims: int) -> Column:
    """Distinct hashed 3- and 4-grams of characters of ``host`` and ``path``
    (hashed apart), plus the bias feature 0; digits of the path count as one digit."""
    def of(text: Column, mark: str) -> Column:
        c = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
        n = F.size(c)

        def hashed(k: int) -> Column:  # the text beside itself, shifted: one pass however long it is
            beside = [F.slice(c, j + 1, F.greatest(n, F.lit(1))).alias(f"c{j}") for j in range(k)]
            grams = F.slice(F.arrays_zip(*beside), F.lit(1), F.greatest(n - k + 1, F.lit(1)))
            return F.transform(grams, lambda z: F.pmod(
                F.hash(F.lit(f"{mark}{k}"), *[z[f"c{j}"] for j in range(k)]), F.lit(dims - 1)) + 1)

        return F.concat(hashed(3), hashed(4))

    return F.array_distinct(F.concat(F.array(F.lit(0)), of(host, "h"), of(F.translate(path, "123456789", "000000000"), "p")))


def train(spark: SparkSession, labelled: list[tuple[int, str]], dims: int, steps: int = 300,
          rate: float = 8.0, ridge: float = 0.001) -> list[float]:
    """Weights of the logistic regression, by full-batch gradient descent.

    The table is small by contract, so descent runs on the examples' Gram
    matrix inside one row (gradient descent from zero keeps the weights a
    combination of the examples). Returns ``dims`` weights."""
    quote = "', '".join
    urls = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({i}, {float(y)}D, '{quote([u.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))])}')"
        for i, (y, u) in enumerate(labelled)) + " AS t(id, y, url)")
    ex = urls.select("id", "y", features(host_of(F.col("url")), path_of(F.col("url")), dims).alias("f"))
    one = ex.agg(F.array_sort(F.collect_list(F.struct("id", "y", "f"))).alias("e"))
    gram = F.transform("e", lambda a: F.transform(
        "e", lambda b: F.size(F.array_intersect(a.f, b.f)) / F.sqrt(F.size(a.f) * F.size(b.f))))
    one = one.select("e", gram.alias("k"), F.transform("e", lambda a: F.lit(0.0)).alias("zero"))
    n = len(labelled)

    def step(alpha: Column, _: Column) -> Column:
        return F.transform("k", lambda row, i: F.get(alpha, i) * (1 - rate * ridge) - F.lit(rate) * (
            1 / (1 + F.exp(-F.aggregate(F.zip_with(row, alpha, lambda x, a: x * a), F.lit(0.0), lambda s, x: s + x)))
            - F.get(F.col("e"), i).y) / n)

    one = one.groupBy().agg(*[F.first(c).alias(c) for c in ("e", "k", "zero")])  # the Gram matrix is made once
    fitted = one.select("e", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("zero"), step).alias("a"))
    pairs = fitted.select(F.explode(F.arrays_zip("e", "a")).alias("z")) \
        .select(F.explode("z.e.f").alias("f"), (F.col("z.a") / F.sqrt(F.size("z.e.f"))).alias("w"))
    weights = [0.0] * dims
    for r in pairs.groupBy("f").agg(F.sum("w").alias("w")).collect():  # at most dims rows
        weights[r.f] = round(r.w, 9)
    return weights


def judge_urls(pages: DataFrame, labelled: list[tuple[int, str]] = LABELLED, rules: list[tuple[str, str]] = RULES,
               dims: int = 16384) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of the model) for every row.
    One projection over (page_id, url): no shuffle at any size."""
    weights = train(pages.sparkSession, labelled, dims)
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one constant
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("f", features(F.col("host"), F.col("path"), dims)).withColumn("w", w)
    margin = F.aggregate("f", F.lit(0.0), lambda s, i: s + F.get("w", i)) / F.sqrt(F.size("f"))
    rule, said = matched_rule(F.col("host"), F.col("path"), rules)
    scored = parts.withColumn("score", 1 / (1 + F.exp(-margin)))
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(said, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
                         "score")
