"""Corpus operators against brute force on small fixtures with nulls, empty
and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import itertools
import os
import random
import re
import sys
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from starkit.llm import byte_bpe, exact_dedup, html_extract, lm_scoring, minhash_dedup, packing, quality_rules, queries, substring_dedup, toxicity, url_filters

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts():
    r = random.Random(3)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base, passage = prose(200).split(), prose(60)
    out = [None, "", " \t\n", "one", "One", "it's  we'll 'tis 12ab ¿qué? 😀\x1c\x85\n\n x"]
    out += [prose(n) for n in (5, 30, 90, 400)]
    out += ["line a b c\n" * 12, "a " * 500, prose(3000), f"{prose(40)} {passage} {prose(40)}", f"{prose(25)}\n{passage}"]
    for k in (0, 3, 8):  # near copies, and copies that differ in white space
        w = list(base)
        for i in r.sample(range(200), k):
            w[i] = "zzz" + str(i)
        out += [" ".join(w), "  ".join(w).upper()]
    return out


@pytest.fixture(scope="module")
def rows():
    t = texts()
    out = [(i, x, ["en", "de", None][i % 3], "s", 1, "k", "n") for i, x in enumerate(t)]
    return out + [out[-1], (None, "null id", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_url_filters(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "allow"), ("a.example.org", "/en/12", "block")]
    urls = [None, "", "no host", "http://", "http://Example.ORG/es/1?x#y", "https://a.example.org/en/123", "http://b.a.example.org/en/1",
            "http://notexample.org/es/", "x://org", "http://org/", "http://example.com/es/"] * 2
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")

    def expected(i, u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        m = re.match(r"([^/?#]*)(/[^?#]*)?", rest)
        host, path = m[1].lower(), m[2] or ""
        fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if ("." + host).endswith("." + h) and path.startswith(p)]
        return (i, host, path, max(fit)[2] if fit else None, max(fit)[3] if fit else "allow")

    out = url_filters.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert as_rows(out, "page_id", "host", "path", "rule", "verdict") == sorted((expected(i, u) for i, u in enumerate(urls)), key=str)
    assert url_filters.judge_urls(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_url_rules_of_the_contract(spark, scratch):
    urls = ["http://example.org/en/1", "http://a.Example.org/en/123?q", "http://example.org/en/2", "http://example.org/es/1", "http://b.org/en/1",
            "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/en/1"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{scratch}/pages.parquet")
    got = [tuple(r) for r in queries.op1_url_filters(spark, scratch).orderBy("page_id").select("rule", "verdict").collect()]
    assert got == [("example.org/en/1", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("example.org/es/", "block"), ("org/", "allow"),
                   ("com/fr/", "allow"), ("com/de/", "block"), (None, "allow")]


def test_sweep_against_all_prefixes(spark, monkeypatch):
    r = random.Random(4)
    key = lambda n: "".join(r.choice("ab") for _ in range(r.randint(0, n)))
    rules, points = sorted({key(4) for _ in range(12)}), [(key(7), i) for i in range(200)]
    out = url_filters.sweep(spark.createDataFrame(points, "key string, id int"), spark.createDataFrame([(k,) for k in rules], "key string"))
    got = {x["id"]: (x["key"], x["stack"]) for x in out.collect()}
    assert got == {i: (k, [p for p in rules if k.startswith(p)]) for k, i in points}
    monkeypatch.setattr(url_filters, "CHUNK", 2)
    out = url_filters.sweep(spark.createDataFrame(points, "key string, id int"), spark.createDataFrame([(k,) for k in rules], "key string"))
    assert {x["id"]: (x["key"], x["stack"]) for x in out.collect()} == got


def test_html_blocks_and_boilerplate(spark):
    page = lambda i: (f"<html><head><title>t</title><script>a</p></script></head><body><nav><a>menu</a></nav><div>please read our very long notice "  # noqa: E731
                      f"about everything on this site</div><p>text number{i} &amp; more\n  of <b>it</b></p><p>second<br>line{i}</p>"
                      "<!-- <p>no --><div class='comments'><p>nice</p></div><form>q</form><footer>foot</footer></body></html>")
    pages = spark.createDataFrame([(i, f"http://h.org/{i}", page(i), "x") for i in range(8)] + [(8, None, None, "x"), (9, "http://h.org/9", "", "x")],
                                  "page_id long, url string, html string, host string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    for i in range(8):
        text = f"text number{i} & more of it\nsecond\nline{i}"
        assert got[i] == (text, len(text))
    assert got[8] == got[9] == ("", 0)
    article = html_extract.main_texts(["<body><div>x</div><article><h1>T</h1><p><b>a<br><p>b</p></article></body>"])
    assert article == ["T\na\nb"]


def test_html_runs(spark):
    rng = random.Random(5)
    page = np.sort(np.array([rng.randrange(9) for _ in range(600)]))
    stream, article = np.array([rng.randrange(2) for _ in page]), page // 2
    outside = np.array([rng.random() < 0.7 for _ in page])
    for run, least in ((1, 2), (5, 3), (6, 4), (8, 2)):
        anywhere, out = {}, {}
        starts = [i for i in range(len(page) - run + 1) if page[i] == page[i + run - 1]]
        for i in starts:
            anywhere.setdefault(tuple(stream[i: i + run]), set()).add(article[i])
            if outside[i]:
                out.setdefault(tuple(stream[i: i + run]), set()).add(article[i])
        for hit, where in zip(html_extract.repeated_runs(stream, page, article, outside, run, least), (anywhere, out)):
            want = np.zeros(len(page), bool)
            for i in starts:
                want[i: i + run] |= len(where.get(tuple(stream[i: i + run]), ())) >= least
            assert (hit == want).all()


def test_html_articles_and_copies(spark, monkeypatch):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    notice, headline = words("notice", 55), words("head", 9)
    unmarked = [f"<div>{words(f'own{i}x', 9)}</div><div>{notice}</div>" for i in range(8)]
    assert html_extract.main_texts(unmarked) == [words(f"own{i}x", 9) for i in range(8)]
    # articles that repeat a sentence keep it, also their headline in a list of links; a notice at one place of most articles goes
    articles = [f"<title>{headline}</title><ul class='related'><li>{headline}</li></ul><article><h1>{headline}</h1>" + "<p>one more</p>" * i
                + f"<p>{notice if i < 4 else words('b', 3)}</p><p>{words(f'own{i}x', 5)}</p><p>{words('cookies', 9)}</p></article>" for i in range(12)]
    for i, text in enumerate(html_extract.main_texts(articles)):
        lines = text.split("\n")
        assert lines[-1] == words(f"own{i}x", 5) and lines[-2] == (notice if i < 4 else words("b", 3))
    # copies of one article, each with a line of its own, on a host of other pages: the article stays, the menu goes
    menu = words("menu", 20)
    copies = [f"<p>{menu}</p><p>{words('story', 40)}</p><p>line {i}</p>" for i in range(4)] + [f"<p>{menu}</p><p>{words(f'other{i}x', 30)}</p>" for i in range(6)]
    texts = html_extract.main_texts(copies)
    assert texts[:4] == [f"{words('story', 40)}\nline {i}" for i in range(4)] and texts[4:] == [words(f"other{i}x", 30) for i in range(6)]
    # a host dealt over groups of few pages: what is on most of its pages is counted over the host; repeated rows, a long page, null urls
    rows = [(i, "http://a.org/1", p) for i, p in enumerate(unmarked)] + [(8, "http://a.org/2", f"<p>{words('long', 100_000)}</p><p>{notice}</p>")]
    rows += [rows[0], (9, None, "<p>x</p>"), (None, None, None)]
    schema = "page_id long, url string, html string"
    monkeypatch.setattr(html_extract, "GROUP_PAGES", 2)
    got = sorted((r.page_id if r.page_id is not None else -1, r.text, r.n_chars) for r in html_extract.extract(spark.createDataFrame(rows, schema)).collect())
    want = [(i, words(f"own{i}x", 9)) for i in range(8)] + [(0, words("own0x", 9)), (8, words("long", 100_000)), (9, "x"), (-1, "")]
    assert got == sorted((i, t, len(t)) for i, t in want)
    assert html_extract.extract(spark.createDataFrame([], schema)).count() == 0


def test_html_text_does_not_depend_on_the_groups_of_a_host(spark, monkeypatch):
    r = random.Random(6)
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    story = lambda i, n: " ".join(f"w{r.randrange(60)}" for _ in range(n)) + f" end{i}"

    def page(i, marked):  # sentences on 20 to 40 % of the pages, in texts of their own; copies of few articles; one on many pages
        notices = "".join(f"<p>{words(f'notice{k}x', 12)}</p>" for k in range(8) if r.random() < 0.2 + 0.03 * k)
        main = words("copied", 30) if r.random() < 0.15 else story(i % 50, 25) if r.random() < 0.8 else words(f"few{i % 3}x", 40)
        body = f"<p>{main}</p><p>line {i}</p>{notices}"
        return f"<title>t{i}</title><div>{words('menu', 10)}</div>" + (f"<div>{notices}</div><article>{body}</article>" if marked else body)

    pages = [(h * 1000 + i, f"http://h{h}.org/{i}", page(i, h and i % 3)) for h, n in ((0, 90), (1, 90), (2, 7)) for i in range(n)]
    pages += [pages[0], (2**60 + 1, "http://h1.org/x", None)]
    expected = []
    for h in range(3):
        host = [p for p in pages if p[1].startswith(f"http://h{h}.")]
        expected += [(p[0], p[1], text, len(text)) for p, text in zip(host, html_extract.main_texts([p[2] for p in host]))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    unclear = []
    saved = html_extract.saved
    monkeypatch.setattr(html_extract, "saved", lambda df, name: (out := saved(df, name), name == "unclear-runs" and unclear.append(out.count()))[0])
    for size, slack in ((1000, 8), (30, 4), (5, 8)):
        monkeypatch.setattr(html_extract, "GROUP_PAGES", size)
        monkeypatch.setattr(html_extract, "SLACK", slack)
        assert as_rows(html_extract.extract(df), "page_id", "url", "text", "n_chars") == sorted(expected, key=str)
    assert unclear[0] and not unclear[1]  # runs that the groups of 30 did not tell were counted again; groups of 5 send all


def test_exact_dedup(spark, docs, rows, empty):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append((-len(r[1] or ""), r[0] is None, r[0] or 0, r[0]))
    out = exact_dedup.exact_dedup(docs, capacity=4).collect()
    assert len(out) == len(rows) and sum(r.kept for r in out) == len(groups)
    by_digest = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[3], len(v)) for k, v in groups.items()}
    assert all((r.keep_id, r.group_size) == by_digest[r.text_sha256] and (not r.kept or r.doc_id == r.keep_id) for r in out)
    sizes = {}
    for r in out:
        sizes.setdefault(r.bucket, set()).add(r.text_sha256)
    assert max(map(len, sizes.values())) <= 4 and max(r.depth for r in out) > 1
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_byte_bpe(spark, docs, rows):
    ranks = byte_bpe.rank_file(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = byte_bpe.Codec(ranks, byte_bpe.class_table())
    r = random.Random(5)
    wild = ["".join(r.choice("abstmdrvel'' \n\t  é1٣!?|😀\x1c\x85ß中") for _ in range(r.randint(0, 40))) for _ in range(2000)] + ["a" * 5000 + " " * 999]
    for t, ids in zip(wild, codec.encode(wild)):
        assert ids.tolist() == library.encode_ordinary(t) and codec.decode(ids) == t.encode()
    got = {x.doc_id: tuple(x) for x in byte_bpe.round_trip(docs, ranks).collect()}
    for i, t, *_ in rows:
        ids = library.encode_ordinary(t or "")
        blob = b"".join(x.to_bytes(4, "little") for x in ids)
        assert got[i] == (i, len(ids), hashlib.sha256(blob).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert byte_bpe.round_trip(docs.limit(0), ranks).count() == 0
    tokens = byte_bpe.encode(docs, ranks)
    assert all(x.offsets[-1] == len(y) for x, y in zip(tokens.orderBy("doc_id").collect(), [b.bytes for b in byte_bpe.decode(tokens, ranks).orderBy("doc_id").collect()]))


def test_substring_dedup(spark, docs, rows, empty):
    seen = {}
    for k, r in enumerate(rows):
        w = WORD.findall(r[1] or "")
        for p in range(len(w) - 34):
            seen.setdefault(tuple(w[p: p + 35]), []).append((k, p))
    gone = {(k, p + i) for places in seen.values() if len(places) > 1 for k, p in places for i in range(35)}
    expected = []
    for k, r in enumerate(rows):
        w = WORD.findall(r[1] or "")
        left = [x for i, x in enumerate(w) if (k, i) not in gone]
        expected.append((r[0], len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    assert as_rows(substring_dedup.substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=str)
    assert substring_dedup.remove_repeats(docs).columns == docs.columns
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_lm_scoring(spark, docs, rows, empty):
    import math
    from collections import Counter

    low = lambda t: [*WORD.findall((t or "").encode().lower().decode()), None]
    held = lambda i: zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1
    c = Counter(w for r in rows if not held(r[0]) for w in low(r[1]))
    total, size = sum(c.values()), len(c)
    out = lm_scoring.score(docs).collect()
    assert len(out) == len(rows)
    by_id = {r[0]: r[1] for r in rows}
    for r in out:
        w = low(by_id[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(x in c for x in w), total)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (total + 0.5 * (size + 1))) for x in w))
        assert r.score < 0
    assert lm_scoring.score(empty).count() == 0


def test_class_model_beats_unigrams_on_held_out_text(spark):
    out = lm_scoring.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    model, base = out.agg({"score": "sum", "base_score": "sum"}).select("sum(score)", "sum(base_score)").first()
    assert model > base


def test_near_dedup(spark, docs, rows, empty):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall((t or "").encode().lower().decode())
        sets[i] = {tuple(w[k: k + 2]) for k in range(len(w) - 1)} or ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations([i for i in sets if i is not None], 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                comp[a] = comp[b] = min(comp[a], comp[b])
    expected = [(r[0], len(sets[r[0]]), comp[r[0]], r[0] == comp[r[0]]) for r in rows]
    assert as_rows(minhash_dedup.near_dedup(docs, shingle=2), "doc_id", "n_shingles", "component_id", "kept") == sorted(expected, key=str)
    assert minhash_dedup.near_dedup(empty).count() == 0


def test_components_of_random_graphs(spark):
    r = random.Random(6)
    edges = {(min(e), max(e)) for e in ((r.randrange(80), r.randrange(80)) for _ in range(70)) if e[0] != e[1]} | {(i, i + 1) for i in range(100, 130)}
    halves = list(edges)[::2], list(edges)[1::2]
    labels = spark.createDataFrame([], "node long, comp long")
    for part in halves:
        labels = minhash_dedup.components(labels, spark.createDataFrame(part, "a long, b long"))
    comp = {n: n for e in edges for n in e}
    for _ in comp:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert {x.node: x.comp for x in labels.collect()} == comp


def test_packing(spark, docs, rows, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    out = packing.pack(docs, path, items_per_task=5).collect()
    assert {x.doc_id for x in out} == {r[0] for r in rows}
    by_id = {r[0]: [*library.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows}
    places, total = {}, 0
    for x in out:
        ids = by_id[x.doc_id][x.start: x.start + x.length]
        assert len(ids) == x.length and x.ids_crc32 == zlib.crc32(b"".join(t.to_bytes(4, "little") for t in ids))
        places.setdefault(x.sequence_id, []).append((x.offset, x.length))
        total += x.length
    assert total == sum(len(by_id[r[0]]) for r in rows)
    for spans in places.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(places) <= -(-total // 1024) + 1
    assert packing.pack(empty, path).count() == 0


def test_toxicity(spark):
    r = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        w = [r.choice("abcdefghij") * r.randint(1, 4) + "o" for _ in range(40)]
        bad = int(r.random() < 0.3)
        if bad:
            w[r.randrange(40)] = w[r.randrange(40)] = r.choice(["clown", "tr4sh", "CLOWN!"])
        rows.append((i, " ".join(w), None, "x"))
        labels.append((i, bad, 1))
    docs = spark.createDataFrame([*rows, (None, None, None, "x"), (-1, "", None, "x")], "doc_id long, text string, lang string, score string")
    known = spark.createDataFrame([*labels, (5000, 1, 1), (None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    out = toxicity.score(docs, known).collect()
    assert len(out) == 602 and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.3) for x in out)
    truth = dict((i, b) for i, b, _ in labels)
    held = [x for x in out if x.held_out and x.doc_id in truth]
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in held)
    assert sum(x.predicted == truth[x.doc_id] for x in held) >= 0.95 * len(held)
    assert toxicity.score(docs.limit(0), known.limit(0)).count() == 0


def test_quality_rules(spark, docs, rows, empty):
    def base(t):
        t = t or ""
        w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        at = {}
        for p in range(len(w) - 7):
            at.setdefault(tuple(w[p: p + 8]), []).append(p)
        covered = {p + k for ps in at.values() if len(ps) > 1 for p in ps for k in range(8)}
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
                len(w) < 20 or 100 * len(covered) > 30 * len(w))

    out = quality_rules.judge(docs)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert as_rows(out, *names) == sorted(((r[0], *base(r[1])) for r in rows), key=str)
    assert all(not r.kept for r in out.filter("base_failed").collect())
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert quality_rules.judge(empty).count() == 0


def test_pipeline(spark, docs, empty):
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, at = at, stage(spark, at, "")
        assert at.columns == docs.columns and at.count() <= before.count()
    ids = {r.doc_id for r in at.collect()}
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, at, "").collect()} == ids
    at = empty
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, "")
    assert at.count() == 0


def test_words_that_are_not_broadcast_are_counted(spark, docs, rows):
    some, few = ({(x.doc_id, x.n_known, x.n_tokens): x.base_score for x in lm_scoring.score(docs, known_words=n).collect()} for n in (lm_scoring.KNOWN_WORDS, 20))
    assert few.keys() == some.keys() and all(few[k] == pytest.approx(some[k]) for k in some)


def test_rare_words_are_clustered_by_their_own_bigrams(spark):
    """All words seen three times or more as units: 12.24 bits a token, with those of 1e-4 of the tokens alone 13.28."""
    out = lm_scoring.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out")
    assert out.selectExpr("-sum(score) / sum(n_tokens) / log10(2)").first()[0] < 12.8


def test_capitals_are_counted_alike_at_every_length():
    at = toxicity.FEATURES.index("capitals")
    for text in ("Word word ÄÖ ǅ 😀\ud800 ", "no capitals here"):
        for n in (1, 4095, 4096, 9000):
            t = (text * n)[:n] or text
            assert toxicity.features_of(t, {}, toxicity.Plain())[at] == pytest.approx(sum(map(str.isupper, t)) / len(t))


def test_packing_of_added_tokens(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext| >", "A  <|ENDOFTEXT|>"])]
    got = {x.doc_id: (x.length, x.ids_crc32) for x in packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
    assert 50256 in library.encode(rows[0][1], add_special_tokens=False).ids
    for i, t in rows:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))


def test_lm_words_of_batches(monkeypatch):
    """Vocabulary and numbers of texts that are split some at a time, against the contract's words."""
    from collections import Counter

    import pyarrow as pa
    import xxhash

    monkeypatch.setattr(lm_scoring, "CHARS", 30)
    monkeypatch.setattr(lm_scoring, "HELD_WORDS", 4)
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 20)
    text = [None, "", " \t\n", "a B\x0bcc\x0cDDDDD\r eeeeee ", "\x1c\x85 Äx\xa0y  b", "a " * 30, "b", "\x00 \x00b \x00\x00"]
    train = [True, True, False, True, False, True, True, False]
    batch = pa.record_batch({"doc": [str(i) if i else None for i in range(len(text))], "train": train, "text": text})
    low = [WORD.findall((t or "").encode().lower().decode()) for t in text]
    got = Counter()
    for b in lm_scoring._word_counts(iter([batch, batch.slice(2, 0)])):
        for word, ending, n in zip(*(c.to_pylist() for c in b.columns)):
            got[word, ending] += n
    key = lambda w: (xxhash.xxh3_64_intdigest(w.encode()) & (1 << 63) - 1, zlib.crc32(w.encode()[-2:] + (b"s" if len(w.encode()) < 6 else b"l")) % lm_scoring.ENDINGS)
    assert got == Counter(map(key, itertools.chain(*low))) + Counter({(lm_scoring.END, lm_scoring.END): len(text)})

    known = ["a", "b"]
    hashes = np.array([key(w)[0] for w in known])
    place = np.argsort(hashes)
    shared = type("Shared", (), {"value": (hashes[place], place)})
    docs = {}
    for b in lm_scoring._numbers(shared)(iter([batch])):
        row = {name: b[name][0].as_py() for name in b.schema.names}
        names = {i: key(w)[0] for i, w in enumerate(known)} | {2: None} | {3 + j: w for j, w in enumerate(row["words"])}
        ids = iter(np.frombuffer(row["ids"], np.int32).tolist())
        for doc, length in zip(row["docs"], row["lengths"]):
            docs[doc] = (row["train"], [names[i] for i in itertools.islice(ids, length)])
        assert dict(zip(row["words"], row["endings"])).items() <= {key(w) for w in itertools.chain(*low)}
    assert docs == {str(i) if i else None: (train[i], [*[key(w)[0] for w in low[i]], None]) for i in range(len(text))}


def test_lm_coarse_rounds_read_pairs(spark, docs, monkeypatch):
    """Only the rounds of all words read the texts; the coarse ones have the same sums from pairs counted once."""
    contexts, unit_pairs, pair_contexts = lm_scoring.contexts, lm_scoring.unit_pairs, lm_scoring.pair_contexts
    read, counted, same = [], [], []
    rows_of = lambda df: sorted((r["range"], bytes(r["keys"]), bytes(r["ns"])) for r in df.collect())

    def of_pairs(pairs, width, class_of, moves):
        out = pair_contexts(pairs, width, class_of, moves)
        same.append(rows_of(out) == rows_of(contexts(*counted[0][:2], class_of, moves)))
        return out
    monkeypatch.setattr(lm_scoring, "HELD", 400)
    monkeypatch.setattr(lm_scoring, "PAIR_RANGE", 16)
    monkeypatch.setattr(lm_scoring, "UNIT_SHARE", 1e-2)
    monkeypatch.setattr(lm_scoring, "contexts", lambda *a: (read.append(a), contexts(*a))[1])
    monkeypatch.setattr(lm_scoring, "unit_pairs", lambda *a: (counted.append(a), unit_pairs(*a))[1])
    monkeypatch.setattr(lm_scoring, "pair_contexts", of_pairs)
    lm_scoring.score(docs)
    assert len(counted) == 1 and same and all(same) and len(read) <= lm_scoring.WORD_ROUNDS + 1


def test_html_blocks_are_decoded_once_each(monkeypatch):
    """Tags without text between them cost no decoding, and change no block."""
    decoded = []
    unescape = html_extract.html_lib.unescape
    monkeypatch.setattr(html_extract.html_lib, "unescape", lambda text: decoded.append(text) or unescape(text))
    page = "<html><body><div><div><p>a &amp; b</p></div></div><br><hr><p>c</p></body></html>"
    assert html_extract.blocks(page) == [("a & b", False, False), ("c", False, False)]
    assert decoded == ["a &amp; b", "c"]


def test_html_token_hashes(monkeypatch):
    """Tokens of a group are found at once, the same as a pattern finds block by block: equal hashes for equal tokens only."""
    r = random.Random(8)
    sign = lambda: chr(r.choice([r.randrange(33, 127), r.randrange(161, 0x3000), r.randrange(0x10000, sys.maxunicode), 0xD800, ord("_"), 0x301]))
    block = lambda: " ".join(" ".join("".join(sign() for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(1, 9))).split()) or "x"
    pages = [[block() for _ in range(r.randrange(4))] for _ in range(300)] + [["abc" * 9_000, "a b", "b a"], [], ["ab", "a-b", "a_b", "a"]]
    expected = [(k, token) for k, text in enumerate(b for page in pages for b in page) for token in html_extract.WORD.findall(text)]
    for chars in (1, 500, 10**6):
        monkeypatch.setattr(html_extract, "PIECE_CHARS", chars)
        hashed, blocks = html_extract.token_hashes(["\n".join(page) for page in pages])
        assert blocks.tolist() == [k for k, _ in expected]
        assert len(set(zip(hashed.tolist(), (t for _, t in expected)))) == len(set(hashed.tolist())) == len({t for _, t in expected})
    none = html_extract.token_hashes(["", ""])
    assert [len(x) for x in none] == [0, 0]


def test_html_tokens_of_a_host_are_not_found_block_by_block(monkeypatch):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    pages = [[(words(f"own{i}x", 9), False, False), (words("notice", 12), False, False), (words("few", 3), False, False)] for i in range(6)] + [[]]
    rows = pd.DataFrame({"host": "h", "hot": False, "split": 0, "article": range(7), "page_id": "1", "url": "u", "name": "", "marked": False,
                         "text": ["\n".join(text for text, _, _ in page) for page in pages], "marks": [bytes(len(page)) for page in pages],
                         "common": [[False] * len(page) for page in pages]})
    monkeypatch.setattr(html_extract, "WORD", None)
    found = html_extract._runs(False)(rows)
    runs = np.sort(found.loc[~found["head"] & (found["n"] >= 3), "run"].to_numpy())
    assert len(runs) == 8  # five inside the notice, three that go on to the block after it; the block before it differs
    texts, = html_extract._texts([rows.assign(runs=[runs] * 5 + [runs[:0], runs])])
    assert texts["text"].tolist() == [f"{words(f'own{i}x', 9)}" + f"\n{words('notice', 12)}\n{words('few', 3)}" * (i == 5) for i in range(6)] + [""]


def test_html_blocks_on_most_pages_of_a_host(spark, monkeypatch):
    """Blocks are counted from the parsed pages' hashes as place_keys counts them; their counts go with the job."""
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    body = lambda i: f"<p>{words('first', 9)}</p>" + f"<p>x{i}</p>" * (i % 3) + f"<p>{words('last', 9)}</p><p>short</p><p>{words(f'own{i}x', 9)}</p>"
    html = {"marked": [f"<p>{words('menu', 9)}</p><article>{body(i)}</article>" for i in range(9)],
            "not": [body(i) for i in range(9)] + [body(0), "", None], "few": [body(0), body(1)]}
    rows = pd.DataFrame([(host, 2, str(i), "u", page) for host, of in html.items() for i, page in enumerate(of)], columns=["host", "groups", "page_id", "url", "html"])
    parsed = pd.concat(html_extract._parsed([rows]))
    pages = spark.createDataFrame([tuple(r) for r in parsed.itertuples(index=False)], html_extract.PARSED)
    names = []
    saved = html_extract.saved
    monkeypatch.setattr(html_extract, "saved", lambda df, name: (out := saved(df, name), names.extend(out.inputFiles()))[0])
    got = {r["host"]: len(set(r["most"])) for r in html_extract.host_blocks(pages).collect()}
    want = {}
    for host, of in html.items():
        page = [html_extract.blocks(x) for x in of]
        want[host] = len(html_extract.on_most_pages(page, [html_extract.place_keys(p, html_extract.sizes(p)) for p in page]))
    assert want == {"marked": 2, "not": 2, "few": 0} and got == {h: n for h, n in want.items() if n}
    assert names and not any(os.path.exists(name.removeprefix("file://")) for name in names)
