"""URL filters: rules by host and path, and for other urls logistic regression on hashed character n-grams.

All urls are judged by built-in functions alone.  The weights come from ``labelled_urls()``: its n-grams are hashed by
the same expressions in Spark, collected (a fixed number of rows) and fitted on the driver.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import linear
from .common import column

#: (host, path, action); a rule fits its host and all subdomains, if the url's path starts with its own; the longest wins.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Rules up to which they are part of the expression; more are joined by the url's host suffixes.
RULES_IN_PLACE = 256
SLOTS, GRAMS, EPOCHS = 1 << 14, (3, 4), 20
THRESHOLD = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def grams(host: Column, path: Column) -> Column:
    """Distinct slots of the n-grams of host and path, between marks for begin and end; time grows with their length only."""

    def of(text: Column, mark: str) -> Column:
        # the characters are bound to a lambda's variable, so that they are split once and not for each n-gram
        return F.get(F.transform(F.array(F.split(F.concat(F.lit("^"), text, F.lit("$")), "")), lambda chars: F.when(text != "", every(chars, mark)).otherwise(F.array().cast("array<bigint>"))), 0)

    def every(chars: Column, mark: str) -> Column:
        def at(i: Column) -> Column:
            slot = lambda n: F.crc32(F.concat(F.lit(f"{mark}{n}:"), *(F.get(chars, i + k) for k in range(n))).cast("binary")) % SLOTS
            return F.array(*map(slot, GRAMS))

        # past the end an n-gram has a null
        return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.size(chars) - min(GRAMS)), at)))

    return F.array_distinct(F.concat(*(of(t, m) for t, m in ((host, "h"), (path, "p")))))


#: Words of hosts of the labelled table, by kind of site; its urls are made from these by rule.
BAD_WORDS = {
    "gambling": "casino poker slots bets betting jackpot blackjack baccarat lottery lotto bingo wager bookie spin stakes vegas highroller",
    "adult": "adult porn sex sexy nude naked escort erotic webcam cams milf fetish camgirl sexcam xxx playboy hookup",
    "pharmacy": "pills viagra cialis xanax steroid tramadol pharmacy weightloss dietpill hgh",
    "money": "payday loans quickcash easymoney getrich forex crypto bitcoin doubler profit investor ponzi cashback freegift giveaway prize winner",
    "fakes": "replica knockoff fakewatch fakeid counterfeit outlet cheapbags",
    "piracy": "warez torrent crack serial nulled cracked pirate leech rapid movies4free streamfree moviez unlock modapk",
    "malware": "malware phish spam trojan botnet hack hacker exploit verify-account login-secure update-now antivirus-alert keylogger spyware",
}
GOOD_WORDS = {
    "learning": "school college university academy science physics chemistry biology algebra geometry library lecture teacher student research institute journal books docs wiki reading english",
    "press": "news herald gazette tribune chronicle courier press radio magazine weekly editor report times post paper",
    "culture": "museum gallery theatre opera concert festival music jazz violin painting poetry novel history archive heritage cinema dance",
    "home": "garden flowers recipes kitchen baking bread furniture carpet knitting sewing woodwork repair decorating plumbing house family health",
    "nature": "forest river mountain ocean birds animals farm weather climate geology fishing hiking camping wildlife harvest",
    "public": "city council court police hospital clinic dentist nursing church parish village county embassy charity transport railway airport harbour station travel",
    "trade": "bank insurance bakery carpenter engineer architect builder consulting logistics factory machinery software hosting printing packaging accounting",
    "sport": "football tennis cricket rowing swimming cycling running athletics hockey stadium league chess sailing skiing",
}
#: Kinds of paths of each label, and those that tell nothing.
BAD_PATHS = ("/free-bonus/", "/win-now/", "/bonus-code/", "/cheap-order/", "/buy-online/", "/download-free/", "/live-girls/", "/claim-prize/", "/signin-verify/", "/hot-videos/", "/instant-cash/", "/no-deposit/")
GOOD_PATHS = ("/about-us/", "/articles/", "/opening-hours/", "/courses/", "/documentation/", "/contact/", "/events/", "/reports/", "/exhibitions/", "/guides/", "/staff/", "/archive/")
PLAIN_PATHS = ("/", "/en/", "/de/", "/fr/", "/index/", "/page/", "/item/")


def labelled_urls() -> list[tuple[str, int]]:
    """The labelled table, 1 for urls to block: fifteen or ten urls a word, so that labels balance, with additions that tell nothing; a third of the paths has the label's kind."""
    before = ("", "my", "best", "online-", "super", "e", "all", "go")
    after = ("", "s", "club", "-x", "24", "hub", "site", "-house", "land", "king", "world", "zone", "direct")
    subs, tops = ("", "www.", "m.", "blog."), ("example.com", "example.net", "example.org")
    rows = []
    for label, kinds, own, each in ((1, BAD_WORDS, BAD_PATHS, 15), (0, GOOD_WORDS, GOOD_PATHS, 10)):
        for i, word in enumerate(" ".join(kinds.values()).split()):
            for j in range(each):
                k = i * 7 + j * 3
                host = word if j == 0 else f"{before[k % len(before)]}{word}{after[(k + j) % len(after)]}"
                path = own[(i + j) % len(own)] if j % 3 == 2 else PLAIN_PATHS[k % len(PLAIN_PATHS)]
                rows.append((f"https://{subs[k % 4]}{host}.{tops[k % 3]}{path}{k * 37 % 999}", label))
    return rows


def trained(spark: SparkSession) -> tuple[list[float], float]:
    """Weights of the slots and the bias, for blocking."""
    rows = labelled_urls()
    table = spark.range(1).select(F.posexplode(F.array(*(F.lit(u) for u, _ in rows))).alias("i", "url"))
    host, path = parts(F.col("url"))
    found = {r.i: r.g for r in table.select("i", grams(host, path).alias("g")).collect()}
    w, bias = _fitted(tuple((tuple(sorted(found[i])), label) for i, (_, label) in enumerate(rows)))
    return w, bias


@lru_cache(maxsize=2)
def _fitted(rows: tuple) -> tuple[list[float], float]:
    w, bias = linear.fit([(list(at), y) for at, y in rows], 2, SLOTS, EPOCHS)
    return [b - a for a, b in zip(*w)], bias[1] - bias[0]


def probability(found: Column, weights: list[float], bias: float) -> Column:
    """Probability that a url with these slots is to be blocked."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in weights)), ",").cast("array<double>")
    total = F.aggregate(found, F.lit(0.0), lambda a, i: a + F.element_at(table, (i + 1).cast("int")))
    z = F.lit(bias) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _rule_in_place(host: Column, path: Column, rules) -> Column:
    """Struct of the longest fitting rule, or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(a).alias("action"))) for h, p, a in rules]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<size:int,rule:string,action:string>")


def rules_by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, best): the longest fitting rule of distinct (host, path), for many rules (host, path, action)."""
    each = urls.select("host", "path").distinct().withColumn("labels", F.split("host", r"\."))
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), ".")))
    told = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), "action")
    hit = each.select("host", "path", suffix.alias("suffix")).join(told, "suffix").where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("suffix", "rule_path")
    return hit.groupBy("host", "path").agg(F.max(F.struct(F.length(rule).alias("size"), rule.alias("rule"), "action")).alias("best"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every url.

    ``score`` is the model's probability of blocking; it decides where no rule fits.  A null url, one without ``://`` or
    without a host is judged by its path alone, or the model's bias.  Repeated rows are each answered.  Rules of one length cannot tie:
    those that fit a url with one length are equal; of equal rules with different actions the later in alphabetical order stands.
    Very long urls are taken whole.  Empty table: no rows.  Other columns may have any names.
    """
    weights, bias = trained(pages.sparkSession)
    host, path = parts(column(pages, "url"))
    urls = pages.select(column(pages, "page_id").alias("page_id"), host.alias("host"), path.alias("path"))
    rules = list(rules)
    if len(rules) <= RULES_IN_PLACE:
        urls = urls.withColumn("best", _rule_in_place(F.col("host"), F.col("path"), rules))
    else:
        table = pages.sparkSession.createDataFrame(rules, "host string, path string, action string")
        urls = urls.join(rules_by_join(urls, table), ["host", "path"], "left")
    urls = urls.withColumn("score", probability(grams(F.col("host"), F.col("path")), weights, bias))
    verdict = F.coalesce(F.col("best.action"), F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow"))
    return urls.select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), "score")
