"""Fingerprints, HTML text, WARC and language against brute-force versions and held-out labels."""

from __future__ import annotations

import base64
import hashlib
import html
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from signals.llm import fingerprint, html_region, language, ngram_join, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PAGES = "page_id long, url string, html string"
DATA = "/root/testdata/sf0.001"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdéñ漢😀") for _ in range(rng.randrange(1, 7)))
    found = [(i * 3, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 5, 40, 300, 300, 3000])]
    base = found[-1][1]
    near = base.split()
    near[1500] = "changed"
    found += [(100, base), (101, base), (102, " ".join(near)), (103, ""), (104, None), (105, "a\n\tb")]
    return found


def brute_edit(texts):
    """Edited text by id, ids being unique."""
    order = sorted(((i, t or "") for i, t in texts), reverse=True)
    out = {}
    for at, (i, text) in enumerate(order):
        following = order[(at + 1) % len(order)][1]
        cut = len(text) // 3
        out[i] = text[: len(text) - cut] + following[:cut]
    return out


def test_fingerprints_edit_as_brute_force(spark, texts):
    rows = {r.doc_id: r for r in fingerprint.op4(spark, documents(spark, texts)).collect()}
    wanted = brute_edit(texts)
    assert {i: r.n_chars for i, r in rows.items()} == {i: len(t or "") for i, t in texts}
    assert {i: r.edited_sha256 for i, r in rows.items()} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in wanted.items()
    }
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows.values())
    assert rows[100].fingerprint == rows[101].fingerprint == rows[15].fingerprint
    assert rows[103].fingerprint == rows[104].fingerprint
    assert rows[101].near_next == 1.0  # 100 holds the same text
    assert 0.7 < rows[102].near_next < 1.0  # 101 differs by one word
    assert rows[9].near_next < 0.2
    assert {i for i, t in texts if wanted[i] == (t or "")} <= {i for i, r in rows.items() if r.near_edited == 1}


def test_fingerprints_of_ties_nulls_one_row_and_none(spark):
    twice = [(1, "one two three four"), (1, "one two three four"), (1, "other words"), (None, "x"), (2, None)]
    rows = fingerprint.op4(spark, documents(spark, twice).withColumn("id", F.lit(1)).withColumn("n", F.lit(1)))
    assert sorted((r.doc_id or -1, r.n_chars) for r in rows.collect()) == [(-1, 1), (1, 11), (1, 18), (1, 18), (2, 0)]
    only = fingerprint.op4(spark, documents(spark, [(5, "abcdef")])).collect()
    assert [(r.near_next, r.edited_sha256) for r in only] == [(1.0, hashlib.sha256(b"abcdab").hexdigest())]
    assert fingerprint.op4(spark, documents(spark, [])).count() == 0


def digest_pairs(spark, sizes, partitions=2):
    """Pairs of digest sets: (shared, only in a, only in b) of each."""
    rng, rows = random.Random(3), []
    for i, (shared, left, right) in enumerate(sizes):
        found = rng.sample(range(-(1 << 31), 1 << 31), shared + left + right)
        rows.append((i, found[: shared + left], found[:shared] + found[shared + left :]))
    return spark.createDataFrame(rows, "id int, a array<int>, b array<int>").repartition(partitions, "id")


def test_peeling_recovers_the_differing_digests(spark):
    """The peeled count is the true symmetric difference, for sets of any size."""
    sizes = [(0, 0, 0), (50, 0, 0), (50, 1, 0), (0, 1, 0), (60, 4, 5), (60, 30, 30), (0, 100, 100), (3, 0, 900)]
    sizes += [(i % 7, i, 2 * i) for i in range(1, 60)]
    pairs = digest_pairs(spark, sizes)
    got = {r.id: (r.differing, r.tried) for r in fingerprint.differences(pairs, ["id"]).collect()}
    wanted = {i: left + right for i, (_, left, right) in enumerate(sizes) if left + right}
    assert {i: n for i, (n, _) in got.items()} == wanted
    assert all(tried <= fingerprint.TRIES for _, tried in got.values())
    cells = fingerprint.subtracted(pairs, ["id"], 1, 100)
    digests = {}
    for r in fingerprint.peeled(cells, ["id"], 100).where("cell < 0").collect():
        digests.setdefault(r.id, set()).add((r.x >> 16, r.n))
    for r in pairs.collect():
        if got.get(r.id, (0, 2))[1] == 1:
            a, b = set(r.a), set(r.b)
            assert digests[r.id] == {(x, 1) for x in a - b} | {(x, -1) for x in b - a}


def test_narrow_sketches_are_retried_larger_and_at_last_compared(spark, monkeypatch):
    sizes = [(10, 5, 5), (0, 60, 60), (5, 300, 300)]
    pairs, true = digest_pairs(spark, sizes), {0: 10, 1: 120, 2: 600}
    monkeypatch.setattr(fingerprint, "STEPS", 1)
    once = fingerprint.subtracted(pairs, ["id"], 1, 100)
    assert fingerprint.peeled(once, ["id"], 100, 1).where("cell >= 0").count() > 0
    assert {r.id: r.differing for r in fingerprint.differences(pairs, ["id"]).collect()} == true
    monkeypatch.setattr(fingerprint, "peeled", lambda cells, *_, **__: cells.withColumn("cell", F.abs("cell")))
    got = {r.id: (r.differing, r.tried) for r in fingerprint.differences(pairs, ["id"]).collect()}
    assert got == {i: (n, fingerprint.TRIES + 1) for i, n in true.items()}


def test_peeling_needs_no_shuffle(spark):
    pairs = digest_pairs(spark, [(5, 2, 2)] * 4)
    made = fingerprint.peeled(fingerprint.subtracted(pairs, ["id"], 1, 1), ["id"], 1).groupBy("id").count()
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


def dice(a, b):
    """Likeness of two texts as sets of word pairs."""
    x, y = ({*zip(["", *t.split()], t.split())} for t in (a, b))
    return 2 * len(x & y) / max(len(x) + len(y), 1)


def test_fingerprints_keep_the_likeness_of_edited_texts(spark):
    """Over whole sf0.01: near the likeness as sets of word pairs, and never lost."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(4)
    rows = {r.doc_id: r for r in fingerprint.op4(spark, docs).collect()}
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    edited = brute_edit(texts)
    spaced = [(i, t) for i, t in texts if len(t.split()) >= 50 and len(t) < 10 * len(t.split())]
    assert len(spaced) > 500
    off = [rows[i].near_edited - dice(t, edited[i]) for i, t in spaced]
    assert all(abs(d) < 0.35 for d in off) and abs(sum(off)) / len(off) < 0.05
    long = [(i, t) for i, t in texts if len(t.split()) >= 96]  # some repeat a few words, so share little anyway
    assert all(rows[i].near_edited > dice(t, edited[i]) - 0.2 and rows[i].near_edited > 0 for i, t in long)


def test_paragraphs_are_enough_whatever_the_text(spark):
    rng = random.Random(5)
    texts = [
        " ".join(f"w{rng.randrange(10**6)}" for _ in range(100)),
        "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(100)),
        "".join(rng.choice("abc(){};=.,") for _ in range(2000)),
        " ".join(f"w{rng.randrange(10**6)}" for _ in range(20_000)),
        "same " * 5000,
    ]
    cut = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select(
        "i", fingerprint.sketch_units(F.col("text")).alias("u")
    ).orderBy("i").collect()
    assert all(50 <= len(r.u.units) <= 400 for r in cut[:4]) and len({u >> 5 for u in cut[4].u.units}) == 2
    assert [r.u.grain for r in cut[:2]] == [0, 0] and cut[3].u.grain > 5
    near = [(10, texts[2]), (9, texts[2][:1000] + "x" + texts[2][1000:]), (8, texts[1]), (7, texts[1][5:])]
    near += [(6, texts[3]), (5, texts[3][: len(texts[3]) // 2]), (4, texts[4]), (3, texts[4] * 3)]
    near += [(2, texts[3]), (1, texts[0])]
    got = {r.doc_id: r.near_next for r in fingerprint.op4(spark, documents(spark, near)).collect()}
    assert got[10] > 0.9 and got[8] > 0.9 and 0.5 < got[6] < 0.8 and got[4] > 0.5
    assert got[2] == 0.0 and got[9] < 0.1


def test_fingerprints_of_blank_texts_are_equal_whatever_follows(spark):
    """Equal texts without words have one fingerprint, also where the edited text has words."""
    rows = {r.doc_id: r for r in fingerprint.op4(spark, documents(spark, [(9, "   "), (8, "abc def"), (7, "   ")])).collect()}
    assert rows[9].fingerprint == rows[7].fingerprint == "0"
    assert rows[9].edited_sha256 == hashlib.sha256(b"  a").hexdigest() and rows[9].edited_fingerprint.startswith("0:[{")


def test_texts_cut_in_two_parts_keep_their_paragraphs(spark):
    """op4 cuts the kept part's words once for text and edited text: as each cut as a whole."""
    rng = random.Random(7)
    some = ["word", "é", "漢字漢字", "x=(aeiou){};" * 4, "a" * 40, "ไทย", "😀", "1,2.3"]
    spaces = [" ", " ", "\n", "\t ", " \r\n", "\u00a0", "\u3000", "", "\x0b"]
    texts = [
        (i, "".join(rng.choice(some) + rng.choice(spaces) for _ in range(rng.choice([1, 3, 40, 400])))) for i in range(40)
    ]
    texts += [(100, " lead"), (101, "trail "), (102, "nospaces" * 30), (103, "\n\n"), (104, " " * 50 + "x")]
    made = fingerprint.compare_with_next(spark, documents(spark, texts)).collect()
    edited = brute_edit(texts)
    whole = spark.createDataFrame([(i, t, edited[i]) for i, t in texts], "id long, t string, e string").select(
        "id", fingerprint.sketch_units(F.col("t")).alias("t"), fingerprint.sketch_units(F.col("e")).alias("e")
    )
    wanted = {r.id: (r.t, r.e) for r in whole.collect()}
    assert {r.id: (r.text_units, r.edited_units) for r in made} == wanted


def test_only_pairs_that_did_not_peel_are_made_again(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "STEPS", 1)
    sizes = [(50, 1, 0), (10, 0, 1), (0, 60, 60), (5, 300, 300)]
    pairs, asked = digest_pairs(spark, sizes), []

    def remade(failed):
        asked.append({r.id for r in failed.collect()})
        return pairs.join(failed, ["id"])

    got = {r.id: r.differing for r in fingerprint.differences(pairs, ["id"], remade).collect()}
    assert got == {0: 1, 1: 1, 2: 120, 3: 600} and asked and all(ids <= {2, 3} for ids in asked)


def page(body, head="<title>T</title><style>p{}</style><script>var a='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


WORDS = "plain words of an article that go on for a while so that the region scores well"
ARTICLE = f"<h1>Head &amp; line</h1><p>{WORDS}.<p>Caf&eacute; <b>bo</b>ld&nbsp;one<br>two\n\n three</p><ul><li>x1<li>x2</ul>"
TEXT = f"Head & line {WORDS}. Café bold one two three x1 x2"
AROUND = (
    '<nav><ul><li><a href="/a">menu</a></li></ul></nav><div class="cookie-notice">we use them</div>',
    '<aside>side</aside><section id="comments"><p>great post said some reader here</p></section><footer>foot</footer>',
)


def test_html_text_of_articles_and_plain_pages(spark):
    inner = (
        '<form><input name=q>find</form><div class="ad">buy now</div><!-- note --><script>x()</script>'
    )
    rows = [
        (1, "u1", page(f"{AROUND[0]}<article>{ARTICLE}</article>{AROUND[1]}")),
        (2, "u2", page(f"{AROUND[0]}<main>{ARTICLE}{inner}</main>{AROUND[1]}")),
        (3, "u3", page(f'{AROUND[0]}<div class="content">{ARTICLE}</div>{AROUND[1]}')),
        (4, None, None),
        (5, "u5", ""),
        (5, "u5", ""),
        (None, "u6", page("")),
        (7, "u7", "<article><p>never closed &lt;tag&gt; " + "word " * 200_000),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    out = html_region.op7(pages).collect()
    texts = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    assert texts[1] == texts[2] == texts[3] == TEXT
    assert texts[4] == texts[5] == texts[None] == ""
    assert texts[7] == "never closed <tag> " + " ".join(["word"] * 200_000)
    assert all(r.n_chars == len(r.text) for r in out)
    assert html_region.op7(pages.limit(0)).count() == 0


@pytest.mark.parametrize("outer", ['<article style="overflow: hidden">', '<article title="hidden gems">', "<article>"])
def test_html_text_keeps_what_only_looks_apart(spark, outer):
    body = (
        f'<div style="overflow:hidden"><p>{WORDS}</p></div><h2 id="binary-search">Binary</h2>'
        f'<section id="related-work"><p id="comment-1" class="notice">{WORDS}</p></section>'
        '<h2 id="social-effects">Effects</h2><p>see <a href="/hidden/x">this</a> <span class="share">too</span></p>'
        f"<p>{WORDS}</p>"
    )
    away = (
        '<div hidden>a1</div><div style="color:red; display: none">a2</div><section id="comments">a3</section>'
        '<div class="ad-slot">a4</div><header hidden>a5</header><ul class="share-buttons"><li>a6</ul>'
    )
    pages = spark.createDataFrame([(1, "u", page(f"{AROUND[0]}{outer}{body}{away}</article>{AROUND[1]}"))], PAGES)
    text = html_region.op7(pages).collect()[0].text
    assert text == f"{WORDS} Binary {WORDS} Effects see this too {WORDS}"


def test_html_scan_finds_the_best_region():
    rng = random.Random(3)
    weights = {"word:p": 1.0, "tag:p": -0.7, "word:link": -1.0, "tag:box": -1.5}
    for _ in range(50):
        found = html_region.Page("")
        names = [rng.choice(list(weights)) for _ in range(25)]
        found.events = [(f, "w" if f.startswith("word") else None, 0, False) for f in names]
        scores = [weights[f] for f in names]
        best = max(sum(scores[i:j]) for i in range(25) for j in range(i, 26))
        start, end = found.best(weights)
        assert sum(scores[start:end]) == pytest.approx(best)


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute_warc(rows, least=0):
    top = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= least and i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        winner = top.get(h or "")
        revisit = winner is not None and winner != i
        out.append((i, len((h or "").encode()), sha1(h), "revisit" if revisit else "response", winner if revisit else None))
    return sorted(out, key=str)


WARC_ROWS = [
    (1, "http://a/é", "<p>same</p>\r\n\r\nWARC/1.1\r\n\r\n"),
    (2, "http://b/", "<p>same</p>\r\n\r\nWARC/1.1\r\n\r\n"),
    (9, "http://c/\r\nX: y", "<p>same</p>\r\n\r\nWARC/1.1\r\n\r\n"),
    (3, None, None),
    (4, "", ""),
    (5, "u", "漢字 😀" * 5000),
    (6, "u", "alone\n"),
    (6, "u", "alone\n"),
    (None, "u", "alone\n"),
]


@pytest.mark.parametrize("least", [0, 20])
def test_warc_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(WARC_ROWS, PAGES).withColumn("digest", F.lit("clash")).repartition(3)
    path = warc.write_warc(pages, f"file://{tmp_path}/w", least)
    back = warc.read_warc(spark, path).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back]
    assert sorted(got, key=str) == brute_warc(WARC_ROWS, least)
    html = {r.page_id: r.payload for r in back if r.record_type == "response"}
    assert html[5] == WARC_ROWS[5][2].encode() and html[9] == WARC_ROWS[2][2].encode()
    assert all(r.payload is None for r in back if r.record_type == "revisit")
    assert all(r.payload is None for r in warc.read_warc(spark, path, payload=False).collect())
    only = warc.read_warc(spark, path, ["revisit"])
    assert {r.record_type for r in only.collect()} == {"revisit"}


def test_warc_filters_reach_the_source(spark, tmp_path):
    path = warc.write_warc(spark.createDataFrame(WARC_ROWS, PAGES), f"file://{tmp_path}/w")
    name = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        rows = warc.read_warc(spark, path).where("record_type = 'response' and page_id in (5, 1)").collect()
    finally:
        spark.conf.set(name, before)
    assert [(r.page_id, r.record_type) for r in rows] == [(5, "response")]


def test_warc_skips_payloads_and_refuses_damage(tmp_path):
    class Stream:
        """Counts the bytes that are read rather than passed over."""

        def __init__(self, raw):
            self.raw, self.read_bytes = raw, 0

        def readline(self):
            return self.raw.readline()

        def read(self, n):
            self.read_bytes += n
            return self.raw.read(n)

        def seek(self, *at):
            return self.raw.seek(*at)

        def seekable(self):
            return True

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 1000\r\n\r\n" + b"x" * 1000 + b"\r\n\r\n"
    file = tmp_path / "a.warc"
    file.write_bytes(record * 3)
    for answer, rows, read in ((None, 0, 0), (False, 3, 0), (True, 3, 3000)):
        with file.open("rb") as raw:
            stream = Stream(raw)
            assert len(list(warc.parse(stream, lambda _: answer))) == rows
            assert stream.read_bytes == read
    file.write_bytes(record[:500])
    with file.open("rb") as raw, pytest.raises(ValueError):
        list(warc.parse(raw, lambda _: True))


def test_warc_of_no_pages(spark):
    assert warc.op8(spark, spark.createDataFrame([], PAGES)).count() == 0


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    found = language.op9(docs, pages).collect()
    assert len(found) == docs.count() + pages.count()
    assert all(0 <= r.probability <= 1 + 1e-9 for r in found)
    by_id = {r.doc_id: r.lang for r in found if r.doc_id is not None}
    held = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and len(r.text.split()) > 20]
    assert sum(by_id[r.doc_id] == r.lang for r in held) >= 0.95 * len(held)
    declared = {r.page_id: html_lang(r.html) for r in pages.collect()}
    right = [declared[r.page_id] == r.lang for r in found if r.page_id is not None]
    assert sum(right) >= 0.95 * len(right)


def html_lang(source):
    said = language.DECLARED.search(source or "")
    return said and said[1]


def test_language_with_nulls_ties_and_clashing_columns(spark):
    en, fr = "the cat sat on the mat with the hat " * 5, "le chat est sur la table avec les amis " * 5
    rows = [(i, en if i % 2 else fr, "en" if i % 2 else "fr", "s", 1) for i in range(20)]
    rows += [(50, None, None, None, None), (51, "", "en", "s", 0), (None, fr, None, None, 1), (1, en, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("host", F.lit("x")).withColumn("p", F.lit(0))
    pages = spark.createDataFrame(
        [(1, "http://[bad", f"<html lang=fr><p>{fr}</p>"), (2, None, None), (None, "http://a.fr/", "")], PAGES
    ).withColumn("text", F.lit(en))
    out = language.op9(docs, pages).collect()
    assert len(out) == len(rows) + 3 and all(r.lang in ("en", "fr") for r in out)
    assert next(r.lang for r in out if r.page_id == 1) == "fr"
    assert {r.lang for r in out if r.doc_id == 1} == {"en"}
    assert language.op9(docs.limit(0), pages.limit(0)).count() == 0


def test_language_priors_decide_without_text(spark):
    """A page without words takes after its host."""
    fr = "le chat est sur la table avec les amis "
    en = "the cat sat on the mat with the hat "
    docs = spark.createDataFrame([(i, (en if i % 2 else fr) * 4, "en" if i % 2 else "fr", f"s{i % 2}", 1) for i in range(40)], DOCS)
    rows = [(i, "http://www.h.fr/a", f"<p>{fr * 3}</p>") for i in range(20)] + [(99, "http://www.h.fr/b", "")]
    out = language.op9(docs, spark.createDataFrame(rows, PAGES)).collect()
    assert next(r.lang for r in out if r.page_id == 99) == "fr"


def brute_posteriors(docs, pages, host_weight=10.0, value_weight=20.0):
    """(doc_id, page_id, lang, probability) of every row, by the formulas of Bayesian fusion written out."""
    counts = {}
    for i, text, lang in docs:
        if lang is not None and zlib.crc32(("" if i is None else str(i)).encode()) % 5:
            counts[lang] = counts.get(lang, 0) + language.trigram_counts(text or "")
    names = sorted(counts)
    seen = np.array([counts[n] for n in names]) + 0.5
    logs = np.log(seen / seen.sum(axis=1, keepdims=True))
    rows = [(i, None, text or "", None, f"source:s{i % 2}", f"source:s{i % 2}", None) for i, text, _ in docs]
    for i, url, source in pages:
        host = url.split("/")[2] if url else None
        domain = ".".join(host.split(".")[-2:]) if host else ""
        text = html.unescape(language.TAG.sub(" ", source))
        rows.append((None, i, text, html_lang(source), host or "", domain, host.split(".")[-1] if host and "." in host else None))
    text_logs, p = [], []
    for row in rows:
        grams = language.trigram_counts(row[2])
        text_logs.append(logs @ grams * min(1 / 3, 300 / max(1, grams.sum())))
        grown = np.exp(text_logs[-1] - text_logs[-1].max())
        p.append(grown / grown.sum())

    def summed(column):
        out = {}
        for row, own in zip(rows, p, strict=True):
            out[row[column]] = out.get(row[column], 0) + own
        return out

    def value_logs(column, own):
        sums = {k: v for k, v in summed(column).items() if k is not None}
        total, values = sum(sums.values(), np.zeros(len(names))), max(1, len(sums))
        for value in sums:
            flat = np.full(len(names), (0.2 if own else 1.0) / values)
            if own and value in names:
                flat[names.index(value)] = 0.8
            sums[value] = np.log((sums[value] + value_weight * flat) / (total + value_weight))
        return sums

    declared, suffixes, hosts, domains = value_logs(3, True), value_logs(6, False), summed(4), summed(5)
    base = sum(p) + 1
    base = base / base.sum()
    out = []
    for row, own, from_text in zip(rows, p, text_logs, strict=True):
        domain = (domains[row[5]] - own + host_weight * base) / (domains[row[5]].sum() - 1 + host_weight)
        host = (hosts[row[4]] - own + host_weight * domain) / (hosts[row[4]].sum() - 1 + host_weight)
        score = from_text + np.log(np.maximum(host, 1e-9)) + declared.get(row[3], 0) + suffixes.get(row[6], 0)
        grown = np.exp(score - score.max())
        out.append((row[0], row[1], names[int(grown.argmax())], grown.max() / grown.sum()))
    return out


@pytest.mark.parametrize("heavy", [10_000, 4])
def test_language_posterior_equals_brute_force(spark, monkeypatch, heavy):
    """Hosts with and without a large share of the rows, weak and mixed evidence of every kind."""
    monkeypatch.setattr(ngram_join, "HEAVY", heavy)
    rng = random.Random(4)
    said = {"en": "the cat sat on mat with hat", "fr": "le chat est sur la table avec", "de": "der hund ist auf dem tisch mit"}
    mixed = lambda n: " ".join(rng.choice(said[rng.choice(list(said))].split()) for _ in range(n))
    docs = [(i, mixed(rng.randrange(12)), rng.choice([*said, None])) for i in range(60)]
    pages = [
        (i, rng.choice(["http://www.a.fr/x", "http://b.a.fr/", "http://c.de/", "http://one/", None]),
         rng.choice(["<html lang=fr>", '<html lang="de">', "<html lang=pt>", ""]) + f"<p>{mixed(rng.randrange(4))}</p>")
        for i in range(80)
    ]
    frame = spark.createDataFrame([(i, t, g, f"s{i % 2}", 0) for i, t, g in docs], DOCS)
    got = {(r.doc_id, r.page_id): r for r in language.op9(frame, spark.createDataFrame(pages, PAGES)).collect()}
    want = brute_posteriors(docs, pages)
    assert len(got) == len(want)
    for i, page_id, lang, probability in want:
        assert abs(got[i, page_id].probability - probability) < 1e-9 and got[i, page_id].lang == lang


PARAGRAPHS = [f"{WORDS} first.", f"{WORDS} last."]
INSIDE = {
    "links": "<ul>" + "".join(f'<li><a href="/{i}">item {i}</a></li>' for i in range(30)) + "</ul>",
    "table": "<table>" + "".join(f"<tr><td>{i}</td><td>{i * i}</td></tr>" for i in range(30)) + "</table>",
    "images": '<img src="x.png" alt="no"><br>' * 40,
    "self-closed": '<svg class="i"/> epsilon <svg viewBox="0 0 1 1" /> zeta',
    "unclosed svg": '<svg class="i"> epsilon zeta',
    "unclosed select": "<select> epsilon zeta",
    "sections": '<section class="related-work"><p>earlier work</p></section><div class="search-results">found</div>',
}


@pytest.mark.parametrize("name", INSIDE)
def test_nothing_inside_an_article_is_lost(spark, name):
    weights = html_region.learn_weights(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
    first, last = PARAGRAPHS
    body = "".join(AROUND) + f"<article><p>{first}</p>{INSIDE[name]}<p>{last}</p></article>" + AROUND[0]
    text = html_region.Page(page(body)).main_text(weights)
    assert text.startswith(first) and text.endswith(last)
    middle = text[len(first) : -len(last)].split()
    wanted = {
        "links": [w for i in range(30) for w in ("item", str(i))],
        "table": [w for i in range(30) for w in (str(i), str(i * i))],
        "images": [], "sections": "earlier work found".split(),
    }
    assert middle == wanted.get(name, ["epsilon", "zeta"])


def test_parts_apart_inside_an_article_still_go(spark):
    apart = "".join(
        f'<div class="{c}"><p>{WORDS} away</p></div>'
        for c in ("related", "related-posts", "comments", "comment-list", "share-buttons", "ad", "advert-box-2")
    )
    body = f"<article><p>{PARAGRAPHS[0]}</p>{apart}<p>{PARAGRAPHS[1]}</p></article>"
    weights = dict(html_region.PRIOR)
    assert html_region.Page(page(body)).main_text(weights) == " ".join(PARAGRAPHS)


def test_deep_and_broken_markup_takes_linear_time():
    import time

    def seconds(source):
        start = time.perf_counter()
        made = html_region.Page(source)
        assert len(made.events) > 1000
        return time.perf_counter() - start

    for piece in ("<div>x", "<svg>x", "<p>x</b></i></div>", "<article><p>x"):
        few, many = seconds(piece * 4000), seconds(piece * 32_000)
        assert many < 40 * few + 0.5, piece


def test_unclosed_script_takes_the_rest():
    body = f"<article><p>{PARAGRAPHS[0]}</p><script>var x = 1; <p>{PARAGRAPHS[1]}</p></article>"
    assert html_region.Page(page(body)).main_text(dict(html_region.PRIOR)) == PARAGRAPHS[0]
