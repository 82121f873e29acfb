"""The pipeline's stages against plain Python: surviving rows, texts after the
substring stage, and the pieces of the last one."""

import math
import random
import re
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from starkit.llm import quality_rules as qr
from starkit.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, __row string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASSES = ["[a-z]", r"[\x20\x09-\x0D]", "[A-Z]", "[0-9]", "[#*$%&|<>]", r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(12)
    vocab = {x: qr.COMMON_WORDS[x] + ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(3, 9))) for _ in range(400)] for x in ("en", "de")}
    prose = lambda lang, n: " ".join(r.choice(vocab[lang][:16] if r.random() < 0.4 else vocab[lang]) for _ in range(n))
    texts = [(prose(x, r.choice([30, 80, 150, 300])), x) for x in ("en", "de") for _ in range(25)]
    passage = prose("en", 50)
    texts += [(f"{prose('en', 60)} {passage} {prose('en', 40)}", "en") for _ in range(3)]
    texts += [(t + "  ", x) for t, x in texts[:4]] + [(t + " end of it", x) for t, x in texts[2:9] if len(t.split()) >= 80]
    texts += [("12 # 34 % " * 60, "en"), ("short text", "de"), (" ".join(f"#{i * 7919}" for i in range(90)), "en"), ("again and again " * 40, "en"), ("", "en"), (None, None), (prose("de", 4000), "de")]
    out = [(i, t, x, "s", len(t or ""), "k", "r") for i, (t, x) in enumerate(texts)]
    return out + [out[1], (None, prose("en", 90), "en", None, None, None, None)]


def histograms(text, lang):
    chars, left = [], text
    for c in CLASSES:
        rest = re.sub(c, "", left)
        chars.append(len(left) - len(rest))
        left = rest
    words, listed = [w.lower() for w in WORD.findall(text)], qr.COMMON_WORDS.get(lang, [])
    common = [sum(w == x for w in words) for x in listed] + [0] * (16 - len(listed))
    return chars + [len(left)], common + [len(words) - sum(common)]


def distance(a, b):
    if not sum(a) or not sum(b):
        return 0.0
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    return math.sqrt(max(0.0, sum(x * math.log2(2 * x / (x + y)) for x, y in [*zip(p, q), *zip(q, p)] if x > 0) / 2))


def good(rows):
    base = []
    for r in rows:
        w, at = WORD.findall(r[1] or ""), {}
        for i in range(len(w) - 7):
            at.setdefault(tuple(w[i:i + 8]), []).append(i)
        covered = {i + k for p in at.values() if len(p) > 1 for i in p for k in range(8)}
        base.append((r, len(w), len(w) >= 20 and 100 * len(covered) <= 30 * len(w), histograms(r[1] or "", r[2])))
    sums = {}
    for r, n, ok, h in base:
        if ok and n >= qr.MIN_WORDS:
            s = sums.setdefault(r[2], [[0] * 7, [0] * 17])
            for total, counts in zip(s, h):
                for k, x in enumerate(counts):
                    total[k] += 1_000_000 * x // sum(counts)
    limits = qr.MAX_CHAR_DISTANCE, qr.MAX_WORD_DISTANCE
    return [r for r, n, ok, h in base if ok and (n < qr.MIN_WORDS or all(distance(a, b) <= most for a, b, most in zip(h, sums[r[2]], limits)))]


def exact(rows):
    best = {}
    for r in rows:
        key, rank = re.sub(r"[\x20\x09-\x0D]", "", r[1]), (-len(r[1]), r[0] is None, r[0] or 0)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    return [r for _, r in best.values()]


def near(rows):
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (re.sub("[A-Z]", lambda m: m[0].lower(), r[1]).split() for r in rows)]
    comp = {r[0]: r[0] for r in rows if r[0] is not None}
    links = [(a[0], b[0]) for i, a in enumerate(rows) for j, b in enumerate(rows[:i])
             if None not in (a[0], b[0]) and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in comp:
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return [r for r in rows if r[0] is None or comp[r[0]] == r[0]]


def repeats_removed(rows):
    words, starts = [WORD.findall(r[1]) for r in rows], {}
    for d, w in enumerate(words):
        for i in range(len(w) - 34):
            starts.setdefault(tuple(w[i:i + 35]), []).append((d, i))
    gone = {(d, i + k) for p in starts.values() if len(p) > 1 for d, i in p for k in range(35)}
    return {r[0]: " ".join(x for i, x in enumerate(w) if (d, i) not in gone) for d, (r, w) in enumerate(zip(rows, words))}


def test_pipeline_against_plain_python(spark, rows):
    at, expected = spark.createDataFrame(rows, SCHEMA).repartition(3), rows
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:3], (good, exact, near)):
        at, expected = stage(spark, at, ""), plain(expected)
        assert sorted(map(tuple, at.collect()), key=key) == sorted(expected, key=key), name
    assert 20 < len(expected) < len(rows) - 15
    kept = repeats_removed(expected)
    at = corpus_pipeline.STAGES[3][1](spark, at, "")
    out = at.collect()
    texts = {r.doc_id: r.text for r in out}  # white space between the kept words is that of the document
    assert {i: " ".join(WORD.findall(t)) for i, t in texts.items()} == kept
    assert sum(len(t.split()) for t in kept.values()) < sum(len(r[1].split()) for r in expected)
    assert all(r.n_chars == len(r.text) for r in out) and at.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.STAGES[4][1](spark, at, "").collect()
    for i, t in texts.items():
        ids, mine = [*library.encode(t, add_special_tokens=False).ids, 2], sorted((p.start, p.length, p.ids_crc32) for p in pieces if p.doc_id == i)
        assert mine[0][0] == 0 and sum(n for _, n, _ in mine) == len(ids)
        assert all(zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[a:a + n])) == crc for a, n, crc in mine)


def test_distances_of_the_quality_rules(spark, rows):
    judged = {r.doc_id: r for r in qr.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i for i, r in judged.items() if r.kept} == {r[0] for r in good(rows)}
    assert any(r.kept for r in judged.values()) and any(not r.kept and not r.base_failed for r in judged.values())
    assert remove_repeats(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0
