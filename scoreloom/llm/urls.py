"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .text import bind

# Fixed values: (verdict, host, path prefix) of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# The small labelled table, host and path of each verdict.
LABELLED = {
    "block": """
        casino-bonus.example/slots/jackpot
        free-casino.example/poker/win-money
        online-poker.example/casino/bonus
        bet-now.example/betting/odds
        sportsbet.example/bet/live-odds
        slots4u.example/free-spins/casino
        xxx-videos.example/adult/cams
        adult-cams.example/xxx/live
        hot-cams.example/porn/videos
        freeporn.example/xxx/gallery
        sex-chat.example/adult/live
        cheap-pills.example/viagra/buy-now
        buy-viagra.example/pharmacy/cheap
        rx-pharmacy.example/pills/no-prescription
        warez-crack.example/keygen/download
        crack-serial.example/warez/keygen
        free-keygen.example/crack/serial
        torrent-warez.example/download/cracked
        adserver.example/banner/click
        ads.tracker.example/click/redirect
        clicktrack.example/ad/banner
        doubleads.example/adclick/pixel
        track.pixel.example/redirect/ads
        win-prize.example/free-gift/claim-now
        get-rich.example/bitcoin/double-money
        crypto-double.example/free-bitcoin/claim
        payday-loans.example/apply-now/cash
        quick-cash.example/loan/approved
        replica-watch.example/cheap/rolex
        fake-bags.example/replica/cheap
    """,
    "allow": """
        docs.library.example/guide/install
        wiki.science.example/article/physics
        en.encyclopedia.example/wiki/history
        news.daily.example/world/report
        news.city.example/politics/election
        blog.garden.example/post/tomatoes
        blog.engineer.example/post/databases
        www.university.example/research/biology
        www.school.example/courses/algebra
        cs.university.example/lectures/compilers
        www.museum.example/collection/paintings
        www.library.example/books/catalogue
        forum.photo.example/thread/lenses
        forum.bikes.example/thread/repair
        recipes.kitchen.example/bread/sourdough
        www.weather.example/forecast/weekly
        www.hospital.example/patients/visiting-hours
        www.council.example/services/recycling
        journal.medicine.example/paper/trial
        journal.maths.example/paper/proof
        archive.letters.example/volume/preface
        www.theatre.example/season/tickets
        travel.north.example/guide/mountains
        m.travel.example/city/museums
        help.software.example/manual/settings
        api.software.example/reference/methods
        de.encyclopedia.example/wiki/geschichte
        fr.encyclopedia.example/wiki/histoire
        es.encyclopedia.example/wiki/historia
        www.bookshop.example/novels/classics
        shop.garden.example/seeds/beans
        www.railway.example/timetable/summer
    """,
}

# Names of sites of each verdict, and words that stand beside them. The words that stand beside both kinds
# teach the model to look at the name.
NAMES = {
    "block": """
        casino poker slots jackpot roulette blackjack betting bets bet bingo lottery wager gambling sportsbook
        porn xxx adult sex escorts cams nude hookup milf erotic
        viagra cialis pills pharmacy xanax tramadol painkillers
        warez crack keygen torrents nulled pirated
        ads adserver adclick banner popup clicks tracker track pixel adtech
        spam backlinks linkfarm doorway clickbait
        loans payday quickcash forex bitcoin prize giveaway replica
        phishing malware trojan spyware
    """,
    "allow": """
        library school museum university science history physics algebra mathematics research language literature
        kitchen bread recipes weather forecast hospital council recycling journal medicine theatre music travel mountain
        software engineer database compiler railway timetable bookshop novels classics painting gallery collection
        garden maple birch river stone harbour lantern meadow orchard willow thistle pebble heron tractor bicycle
        parliament election newspaper report thread forum archive letters volume nation station condition tension
        mother brother weathervane northern southern heather leather gathering other thesis theory
        essex middlesex adapter address adventure advice admiral shadow meadows badminton winter window wind twins
        alphabet better beta letterbox sorbet tibet analysis therapist camera cambridge pillow pilot pillar spinning
        spaniel spanish sparrow tracing tractors trackside crackers cryptography popular popcorn banners bannister
        lottie poetry slope sextant sexton hotel hothouse chess press expression pixels loanword replication
        training turing reading angling shingle stand handle errand holland thousand wheat shore horse
        restoration interest estuary history story order border corner enterprise internet render veranda
    """,
}
BESIDE = {
    "block": "online now 4u best hot live lucky king bonus deals pro store club play direct vip super24",
    "allow": "home free online new my best north live house city old green club shop play store direct",
}
# What hosts and paths of either verdict look like.
SUBDOMAINS = ("", "www.", "m.", "blog.")
SUFFIXES = (".example.com", ".example.net", ".example.org", ".example")
PATHS = ("/", "/en/1204", "/de/88.html", "/fr/7712/", "/es/345", "/index.html", "/en/70421.html")

GRAMS = (3, 4, 5)
FEATURES = 1 << 16
REGULARISATION = 0.001
ALLOW_WEIGHT = 3.0  # of an allowed url in training: a url blocked by mistake costs a document


def labelled_urls() -> list[tuple[str, str, str]]:
    """(verdict, host, path): the labelled table, and every name alone and beside other words.

    Both verdicts take the same subdomains, suffixes and paths in turn, so that only names and words tell them apart.
    """
    rows = [
        (verdict, line.split("/", 1)[0], "/" + line.split("/", 1)[1])
        for verdict, lines in LABELLED.items() for line in lines.split()
    ]
    for verdict, names in NAMES.items():
        beside = BESIDE[verdict].split()
        for k, name in enumerate(names.split()):
            sites = [name]
            for word in (beside[(k + step) % len(beside)] for step in (0, 5, 10)):
                sites += [f"{name}-{word}", f"{word}-{name}", f"{name}{word}"]
            for j, site in enumerate(sites):
                host = SUBDOMAINS[(k + j) % len(SUBDOMAINS)] + site + SUFFIXES[(k // 4 + j) % len(SUFFIXES)]
                rows.append((verdict, host, PATHS[(k + 2 * j) % len(PATHS)]))
    return rows


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as struct (rule, verdict), else null; of equal length the longer host."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, site, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(site + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(text: Column, mark: str, end: str) -> Column:
    """Character n-grams of a text with its ends marked; ``mark`` keeps host and path apart.

    An end looks like a border inside, so that a name gives the same n-grams with a subdomain and without.
    """
    def grams(letters: Column, n: int) -> Column:
        last = F.size(letters) - n + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.array_join(F.slice(letters, i, F.lit(n)), "")))

    # Parts of a list are found at once, those of a long string by counting from its beginning.
    letters = F.regexp_extract_all(F.concat(F.lit(end), text, F.lit(end)), F.lit("(?s)."), F.lit(0))
    return bind(letters, lambda x: F.concat(*[grams(x, n) for n in GRAMS]))


def with_grams(frame: DataFrame) -> DataFrame:
    lower = F.lower(F.col("path"))
    return frame.withColumn("_grams", F.concat(_grams(F.col("host"), "h:", "."), _grams(lower, "p:", "/")))


def train(spark: SparkSession, labelled: list[tuple[str, str, str]] | None = None) -> PipelineModel:
    """Fit the regression on labelled URLs (verdict, host, path); 1 is block."""
    rows = [
        (host, path, float(verdict == "block"), 1.0 if verdict == "block" else ALLOW_WEIGHT)
        for verdict, host, path in labelled or labelled_urls()
    ]
    table = with_grams(spark.createDataFrame(rows, "host string, path string, label double, weight double").coalesce(1))
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True)
    regression = LogisticRegression(
        featuresCol="_features", weightCol="weight", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class",
        maxIter=100, regParam=REGULARISATION, standardization=False,
    )
    return PipelineModel([hashing, regression.fit(hashing.transform(table))])


def judge(pages: DataFrame, model: PipelineModel, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every url.

    Where no rule fits, the regression blocks from ``threshold`` on. A null url, and one without
    ``://``, has empty host and path and is judged like any other; repeated rows are judged each; an
    empty table gives no rows; further columns are ignored. Long urls are judged by their whole text.
    """
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = model.transform(with_grams(split))
    ruled = rule_for(F.col("host"), F.col("path"), rules)
    score = vector_to_array("_probability")[1]
    return scored.withColumn("_rule", ruled).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(score >= threshold, "block").otherwise("allow")).alias("verdict"),
        score.alias("score"),
    )
