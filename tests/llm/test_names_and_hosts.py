"""Clashing column names, and hosts that the seed of the url filter does not hold."""

from framesift.llm import language, minhash, urlfilter

NEUTRAL = (
    "en.wikipedia.net", "www.bbc.co.uk", "stackoverflow.net", "nytimes.net", "harvard.edu", "nasa.gov", "openstreetmap.de", "spotify.net", "docs.python.net",
    "quora.net", "medium.net", "reuters.net", "mit.edu", "blog.cloudflare.net", "amazonaws.net", "lemonde.net", "zeit.de", "elpais.net", "gutenberg.net", "kernel.net",
)
UNWANTED = ("megacasino777.net", "pokerstars24.net", "adultfriends.net", "bestviagra.net", "slotsmachine.info", "payday4you.info", "warezcity.net", "gamblingtips.net")


def test_unseen_hosts(spark):
    seed = urlfilter.seed_table(spark)
    hosts = {r.host for r in seed.select(urlfilter.host_of(seed.url).alias("host")).collect()}
    assert not hosts & {*NEUTRAL, *UNWANTED}
    rows = [(h, f"https://{h}/wiki/Item?x=1", 7) for h in (*NEUTRAL, *UNWANTED)] + [("none", None, 7), ("bad", "not a url", 7)]
    out = {r.name: r for r in urlfilter.judge(spark.createDataFrame(rows, "name string, url string, rule_of_ int"), seed).collect()}
    assert sum(out[h].verdict == "allow" for h in NEUTRAL) >= 19
    assert sum(out[h].verdict == "block" for h in UNWANTED) >= 6
    assert out["none"].verdict == out["bad"].verdict == "allow" and out["none"].rule_of_ == 7


def test_clashing_names(spark):
    texts = ["the cat and the other thing are with that and this " * 3, "de la que el en los por las una con " * 3]
    names = "doc_id long, text string, lang string, source string, gone long, _gone long, _h string, _hk string, _t string, own_t string, id_kept string, print long, component long"
    docs = spark.createDataFrame([(i, texts[i % 2], ("en", "es")[i % 2], "s", 1, 2, "h", "k", "t", "o", "i", 3, 4) for i in range(8)], names)
    kept = language.kept_documents(docs)
    assert kept.columns == docs.columns and {r._h for r in kept.collect()} <= {"h"}
    alone = minhash.kept_documents(docs)
    assert alone.columns == docs.columns and sorted(r.doc_id for r in alone.collect()) == [0, 1]
