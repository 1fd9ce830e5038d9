"""URL filters: listed rules, and logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table. Its features are the character
n-grams of host and path, hashed to a fixed number of slots and divided by the square
root of their number. Training is accelerated gradient descent on the dual coefficients, one for
each labelled URL, over the table's kernel matrix, until it has converged; a round of
steps is one SQL expression, and the result is one weight a slot. The table's size is
bounded (MOST_LABELLED), so the matrix is too. The step follows from the matrix's
largest sum of a row, which bounds its eigenvalues, so it converges on any table.

The built-in table holds common words of unwanted and of ordinary sites. THRESHOLD is
chosen on names that the model was not trained on (held_out, choose_threshold): of all
thresholds, the one with the most recall less four times the share of ordinary names
blocked.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no
rule and is judged by the model's bias alone; very long URLs are read whole; of rules
that fit and are equally long, the first wins; repeated URLs get the same verdict, and
repeated labelled rows count once; an empty table gives no rows, and an empty labelled
table a model that allows all; columns named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.llm.store import keep_names, materialise, release

SIZES = (3, 4, 5)
SLOTS = 1 << 15
MOST_LABELLED = 512
#: Penalty on the weights' squares; steps of a round; largest gradient at the end; most rounds.
SHRINK, STEPS, TOLERANCE, ROUNDS = 1.0, 50, 1e-6, 200
#: Square of the constant feature, whose weight is the bias.
BIAS = 0.1
#: Log odds above which a URL is blocked.
THRESHOLD = 0.35
#: Parts of the labelled names that are left out in turn to choose THRESHOLD, and what a good name that is blocked costs there.
FOLDS, COST = 5, 4

#: Rules: (verdict, host, path). A rule holds for its host and all subdomains.
RULES: tuple[tuple[str, str, str], ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

_BLOCKED = """
lucky-casino vegas-slots poker-bonus roulette-online jackpot-city sports-betting betting-odds bingo-prizes
discount-pharmacy buy-viagra cialis-online diet-pills no-prescription-meds pharma-deals adult-webcams xxx-videos
porn-tube sexy-singles escort-girls hot-dating popup-ads adserver banner-clicks click-tracker
seo-backlinks spam-mailer link-exchange traffic-exchange free-money win-prizes payday-loans easy-credit
replica-watches fake-designer-bags crypto-doubler cash-from-home miracle-cure lottery-winner cheap-software cracked-downloads
""".split()
_ALLOWED = """
library museum university physics-notes school-district city-council weather daily-herald
science-journal recipes gardening travel-diary open-source developer-guide local-history theatre
chess-club public-health northern-parks train-times orchestra astronomy language-school encyclopedia
mathematics handbook national-archive bird-watching family-doctor book-reviews farmers-market photography
fire-brigade law-review river-trust film-festival bakery bike-repair cathedral kindergarten
""".split()
#: How the names above become URLs: their hosts and paths.
_HOSTS = ("{}.com", "www.{}.org", "{}.info", "shop.{}.co.uk")
_PATHS = ("/", "/index.html", "/article/12", "/2024/05/", "/de/about", "/search")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The built-in labelled table: url, blocked (0 or 1), fold. Every name comes under every host, with paths dealt alike; a name is in one fold."""
    rows = []
    for blocked, names in ((1, _BLOCKED), (0, _ALLOWED)):
        for i, name in enumerate(names):
            rows += [(f"https://{host.format(name)}{_PATHS[(i + j) % len(_PATHS)]}", blocked, i % FOLDS) for j, host in enumerate(_HOSTS)]
    return spark.createDataFrame(rows, "url string, blocked int, fold int")


def host_of(url: Column) -> Column:
    """What stands between the first :// and /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, the first of equals; null if none."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(text: Column, slots: int = SLOTS) -> Column:
    """The slots of text's n-grams, one entry for each gram of each size; any digit counts as 0."""
    text = F.translate(text, "123456789", "000000000")

    def of_size(n: int) -> Column:
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(text, i, F.lit(n))), F.lit(slots)).cast("int"))

    return F.concat(*map(of_size, SIZES))


def train(labelled: DataFrame, slots: int = SLOTS) -> tuple[float, list[float]]:
    """Bias and one weight for each slot, from url and blocked of at most MOST_LABELLED rows."""
    rows = labelled.select("url", "blocked").filter(F.col("url").isNotNull() & F.col("blocked").isin(0, 1)).distinct()
    if (n := rows.count()) > MOST_LABELLED:
        raise ValueError(f"{n} labelled URLs; the table may have {MOST_LABELLED}")
    if not n:
        return 0.0, [0.0] * slots
    numbered = rows.select("blocked", "url", F.concat(host_of(F.col("url")), path_of(F.col("url"))).alias("t"))
    exploded = numbered.select("url", "blocked", F.explode(grams(F.col("t"), slots)).alias("slot"))
    of_url = numbered.select("url", "blocked", F.greatest(F.size(grams(F.col("t"), slots)), F.lit(1)).alias("n"))
    count = exploded.groupBy("url", "blocked", "slot").count()
    # grams that most of the table has, as of its hosts' endings, weigh little
    rare = count.groupBy("slot").agg(F.log(F.lit(float(n + 1)) / F.count(F.lit(1))).alias("rare"))
    x = count.join(of_url, ["url", "blocked"]).join(rare, "slot").select("url", "blocked", "slot", "rare", (F.col("count") * F.col("rare") / F.sqrt("n")).alias("x"))
    x = materialise(x)
    # the kernel matrix by an equal join on slots
    a, b = x.alias("a"), x.alias("b")
    k = a.join(b, F.col("a.slot") == F.col("b.slot")).groupBy(F.col("a.url").alias("u"), F.col("b.url").alias("v")).agg(F.sum(F.col("a.x") * F.col("b.x")).alias("k"))
    names = numbered.select("url", "blocked").alias("n")
    # every row of the matrix as a map from url to k, rounded so that the order of summing doesn't show
    lines = k.groupBy("u").agg(F.map_from_entries(F.collect_list(F.struct("v", F.round("k", 9)))).alias("line"))
    table = names.join(lines, F.col("n.url") == F.col("u"), "left").select(F.struct(F.col("n.url").alias("url"), F.col("n.blocked").alias("y"), "line").alias("r"))
    one = table.agg(F.sort_array(F.collect_list("r.url")).alias("urls"), F.map_from_entries(F.collect_list(F.struct("r.url", F.struct("r.y", "r.line")))).alias("of"))
    matrix = one.select(
        "urls",
        F.transform("urls", lambda u: F.col("of")[u]["y"].cast("double")).alias("y"),
        F.transform("urls", lambda u: F.transform("urls", lambda v: F.coalesce(F.try_element_at(F.col("of")[u]["line"], v), F.lit(0.0)) + BIAS)).alias("k"),
    )
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, v: s + v)
    dot = lambda row, alpha: total(F.zip_with(row, alpha, lambda p, q: p * q))
    # no eigenvalue of the matrix is above the largest sum of a row
    steep = SHRINK + F.array_max(F.transform("k", total)) / 4
    root = F.sqrt(steep / SHRINK)
    matrix = matrix.withColumns({"rate": 1 / steep, "push": (root - 1) / (root + 1)})
    matrix = materialise(matrix)  # else the expression for k would run again in every step
    downhill = lambda alpha: F.transform(F.arrays_zip(F.col("k").alias("k"), F.col("y").alias("y"), alpha.alias("a")), lambda r: r["y"] - 1 / (1 + F.exp(-dot(r["k"], alpha))) - SHRINK * r["a"])

    def step(m: Column, _: Column) -> Column:
        """Nesterov's: a step downhill from where the last move would lead."""
        ahead = F.zip_with(m["a"], m["was"], lambda a, was: a + F.col("push") * (a - was))
        return F.get(F.transform(F.array(ahead), lambda v: F.struct(F.zip_with(v, downhill(v), lambda a, d: a + F.col("rate") * d).alias("a"), m["a"].alias("was"))), F.lit(0))

    none = F.array_repeat(F.lit(0.0), n)
    alpha = materialise(matrix.withColumn("m", F.struct(none.alias("a"), none.alias("was"))))
    for _ in range(ROUNDS):
        moved = materialise(alpha.withColumn("m", F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.col("m"), step)))
        release(alpha)
        alpha = moved
        if alpha.select(F.array_max(F.transform(downhill(F.col("m.a")), F.abs))).first()[0] <= TOLERANCE:
            break
    alpha = alpha.withColumn("a", F.col("m.a"))
    pairs = alpha.select(F.explode(F.arrays_zip("urls", "a")).alias("p")).select(F.col("p.urls").alias("url"), F.col("p.a").alias("a"))
    found = pairs.join(x, "url").groupBy("slot").agg(F.round(F.sum(F.col("a") * F.col("x") * F.col("rare")), 9).alias("w")).collect()  # at most one row a slot
    weights = [0.0] * slots
    for r in found:
        weights[r["slot"]] = r["w"]
    bias = alpha.select(F.round(F.aggregate("a", F.lit(0.0), lambda s, v: s + v) * BIAS, 9)).first()[0]
    release(x, matrix, moved)
    return bias, weights


def held_out(labelled: DataFrame) -> list[tuple[float, int]]:
    """(score, blocked) of every labelled URL (url, blocked, fold) by the model that is trained without its fold."""
    out = []
    for fold in range(FOLDS):
        model = train(labelled.filter(F.col("fold") != fold))
        text = F.concat(host_of(F.col("url")), path_of(F.col("url")))
        out += [tuple(r) for r in labelled.filter(F.col("fold") == fold).select(score(text, model), "blocked").collect()]  # MOST_LABELLED rows at most
    return out


def choose_threshold(scored: list[tuple[float, int]]) -> float:
    """The least threshold, in steps of 0.05, that gains most: recall less COST times the share of good URLs blocked."""
    bad, good = ([s for s, b in scored if b == k] for k in (1, 0))
    gain = lambda t: sum(s > t for s in bad) / len(bad) - COST * sum(s > t for s in good) / len(good)
    steps = [i / 20 for i in range(-40, 41)]
    return max(steps, key=lambda t: (round(gain(t), 9), -t))


def score(text: Column, model: tuple[float, list[float]]) -> Column:
    """Log odds that a URL with this host and path is to be blocked."""
    bias, weights = model
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one literal
    ids = grams(text, len(weights))
    total = F.aggregate(ids, F.lit(0.0), lambda s, i: s + F.get(table, i))
    return bias + total / F.sqrt(F.greatest(F.size(ids), F.lit(1)))


def judge(pages: DataFrame, model: tuple[float, list[float]], url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """pages with host, path, rule, verdict; columns of these names are replaced."""
    at = F.col(f"`{url}`")
    parts = pages.withColumns({"__p_host": host_of(at), "__p_path": path_of(at)})
    host, path = F.col("__p_host"), F.col("__p_path")
    ruled = parts.withColumn("__p_rule", rule_of(host, path, rules))
    said = F.when(F.col("__p_rule").isNotNull(), F.col("__p_rule.verdict")).when(score(F.concat(host, path), model) > THRESHOLD, "block").otherwise("allow")
    out = keep_names(ruled, {"host": host, "path": path, "rule": F.col("__p_rule.rule"), "verdict": said})
    return out.drop("__p_host", "__p_path", "__p_rule")
