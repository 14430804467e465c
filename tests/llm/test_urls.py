"""Rules and vocabulary against a plain Python version."""

import compare
import pytest

from nextpick.llm import urls

SF_DIR = "/root/testdata/sf0.001"
URLS = [None, "", "no scheme", "HTTP://Www.Example.COM/en/x", "http://example.com/en", "http://example.com/en/", "http://a.example.com/EN/1",
        "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "ftp://free.casino.org", "http://free-win.org/?q=1", "http://freewin.org/",
        "http://cheap.org/cheap", "http://a.org#free/ads", "http://com", "http://com/", "://", "http://é.org/pills", "http://spam.net/de/",
        "http://a.net/es/?x=http://b.com/en/", "x" * 100_000 + "://y.com/"]


def plain(url):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        rule, verdict = max(fits, key=lambda f: len(f[0]))
        return host, path, rule, verdict
    words, word = set(), ""
    for c in low + "\n":
        if c.isascii() and c.isalnum():
            word += c
        else:
            words.add(word)
            word = ""
    blocked = words & set(urls.STRICT) or sum(urls.SOFT.get(w, 0) for w in words) >= urls.SOFT_LIMIT
    return host, path, None, "block" if blocked else "allow"


def test_against_python(spark):
    frame = spark.createDataFrame([(i, u, "extra", "extra") for i, u in enumerate(URLS)] + [(None, None, None, None), (3, URLS[3], "", "")],
                                  "page_id long, url string, host string, rule string")
    rows = urls.judge(frame).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(URLS[r.page_id] if r.page_id is not None else None), r


def test_query_against_python_and_sql(spark):
    texts = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = urls.op4_urls(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == plain(texts[r.page_id])
    assert compare.spark_rows(urls.op4_urls(spark, SF_DIR)) == compare.duckdb_rows(compare.connect(SF_DIR), urls.ORACLE)


def test_empty(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


@pytest.mark.parametrize(("url", "hits"), [("http://xcasino.org", (0, 0)), ("http://casino.org/casino", (1, 0)), ("http://free.org/free-ads", (0, 2))])
def test_term_hits(url, hits):
    assert urls.term_hits(urls._automaton(urls.STRICT, urls.SOFT), url) == hits


def _verdict(spark, url):
    return urls.judge(spark.createDataFrame([(1, url)], "page_id long, url string")).first().verdict


@pytest.mark.parametrize(("words", "verdict"), [
    (["stripper", "rabatt", "coupon"], "block"),        # one heavy, two light: 2.5
    (["stripper", "rabatt"], "block"), (["stripper"], "allow"), (["rabatt", "coupon", "geld"], "allow"),
    (["rabatt", "coupon", "geld", "offre"], "block"),   # four light
    (["lotto", "rabatt"], "allow"), (["lotto", "rabatt", "coupon"], "block"), (["lotto", "premio"], "block"),
    (["coupon", "coupons", "coupon", "coupons"], "allow"),  # one term
    (["glücksspiel"], "block"), (["gluecksspiel"], "block"), (["gl%C3%BCcksspiel"], "block"), (["Glücksspielen"], "block"),
    (["c4sino"], "block"), (["p0rno"], "block"), (["p0rn0"], "block"), (["free%20spins"], "block"), (["Free_Spins"], "block"), (["machine-a-sous"], "block"),
    (["weight", "rabatt", "loss"], "allow"), (["weight-loss", "rabatt"], "block"), (["freespinster"], "allow")])
def test_weights_and_forms(spark, words, verdict):
    assert _verdict(spark, f"http://a.org/{'/'.join(words)}") == verdict


def test_vocabulary():
    assert len(urls.STRICT) > 150 and len(urls.SOFT) > 300 and not set(urls.STRICT) & set(urls.SOFT)
    assert max(urls.SOFT.values()) < urls.SOFT_LIMIT  # a soft term alone never blocks
    owner = {}
    for term, own in [*urls.STRICT_FORMS.items(), *urls.SOFT_FORMS.items()]:
        for form in own:
            assert owner.setdefault(form, term) == term, form
    parts = {w for term in urls.SOFT_FORMS if "_" in term for w in term.rstrip("*").split("_")}
    assert not parts & set(urls.SOFT)  # or such a term would count twice


def test_forms_against_sql(spark):
    rows = [(i, f"http://h{i}.org/{form}/x") for i, form in enumerate([*urls.STRICT, *urls.SOFT])]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    connection = compare.duckdb.connect()
    connection.register("pages", frame.toPandas())
    assert compare.spark_rows(urls.judge(frame)) == compare.duckdb_rows(connection, urls.ORACLE)
