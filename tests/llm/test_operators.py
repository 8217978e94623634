"""Operators against brute force on texts with nulls, empties, copies and long documents."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import (components, decontaminate, jaccard_join, language_id, lm_scoring, packing, quality_rules,
                          secret_scan, substring_dedup, toxicity, url_filter, words)

SCHEMA = "doc_id bigint, text string, lang string, n int, windows string"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def some_texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice(["th", "er", "on", "é", "ion", "A", "x"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = draw(200), draw(60)
    near = base.split()
    near[20] = "changed"
    texts = [None, "", " \n\t", "one", "Two two", base, base, " ".join(near), base.upper(), base.replace(" ", "\n"),
             draw(100) + " " + passage + " " + draw(30), passage + " " + draw(80), draw(5000), "a " * 300, "the the the",
             "x" * 5000, "Ab. Cd, ef.\nAb. Cd, ef.", passage, draw(40), "a b c d " * 50]
    return [(i, t, "en" if i % 2 else "fr", i, "w") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(some_texts(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


TEXTS = {row[0]: row[1] for row in some_texts()}


def test_word_chunks_match_a_regex():
    texts = list(TEXTS.values())
    for limit in (1, 100, 1 << 20):
        found, seen = [], {}
        for chunk in words.chunks(pa.array(texts), words.space_separated(), limit=limit):
            hashes = chunk.hashes()
            for row in range(chunk.rows):
                mine = range(chunk.bounds[row], chunk.bounds[row + 1])
                found.append([chunk.word(i).decode() for i in mine])
                assert all(seen.setdefault(int(hashes[i]), chunk.word(i)) == chunk.word(i) for i in mine)
        assert found == [space_words(t) for t in texts]


def test_quality_figures(docs, empty):
    for row in quality_rules.judged(docs).collect():
        text = TEXTS[row.doc_id] or ""
        w = space_words(text)
        triples = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        count = Counter(triples)
        again = {j for i, t in enumerate(triples) if count[t] > 1 for j in range(i, i + 3)}
        lines = [x for x in text.split("\n") if space_words(x)]
        assert (row.n_words, row.word_chars, row.n_repeat_words, row.n_dup_lines) == (
            len(w), sum(map(len, w)), len(again), len(lines) - len(set(lines)))
        assert row.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (row.kept and row.base_failed)
    assert quality_rules.judged(empty).count() == 0


def test_quality_removes_menu_and_legal_lines(spark):
    body = "\n".join(f"Line{i} holds{i} several{i} different{i} words{i} here{i}." for i in range(12))
    rows = [(1, body + "\nHome | About | Contact\nAll rights reserved."), (2, "\n".join(["Home | About | Contact | More"] * 40))]
    found = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found[1].kept and found[1].n_bad_lines == 2 and found[1].clean_text == body
    assert not found[2].kept


def test_secrets(spark, empty):
    key = "Zq8vT1xKp3Lm9RbW5nYc7HdJ2sFg"
    text = f"password = hunter22! Token: 'abc' {'ab12' * 8} AKIA{'Z9' * 8} {key} 123e4567-e89b-12d3-a456-426614174000 plainwordsareneverkeysatall"
    found = secret_scan.find_secrets(spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string"))
    rows = {r.doc_id: r for r in found.collect()}
    kinds = [(s.kind, text[s.start:s.end]) for s in rows[1].spans]
    assert kinds == [("assign", "password = hunter22"), ("hex", "ab12" * 8), ("access", "AKIA" + "Z9" * 8), ("entropy_base64", key)]
    digest = {r.doc_id: r for r in secret_scan.digest(found).collect()}
    assert digest[2].base_sha256 == digest[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secret_scan.find_secrets(empty).count() == 0
    masked = secret_scan.mask_secrets(spark.createDataFrame([(1, text, 5), (2, None, 6)], "doc_id bigint, text string, spans int"))
    assert masked.columns == ["doc_id", "text", "spans"] and key not in masked.where("doc_id = 1").first().text


def test_secrets_beside_known_spans_and_placeholders():
    key, run = "Zq8vT1xKp3Lm9RbW5nYc7HdJ2sFg", "0a1b2c3d4e5f6978" * 2
    scanner = secret_scan.Scanner()
    covered = lambda text: {i for _, s, e in scanner.spans(text) for i in range(s, e)}
    behind = f"{run}_{key}"
    assert ("hex", 0, 32) in scanner.spans(behind) and covered(behind) >= set(range(len(behind) - len(key), len(behind)))
    around = f"{key}_{run}_{key}"
    assert covered(around) >= set(range(len(key))) | set(range(len(around) - len(key), len(around)))
    assert key not in scanner.masked(behind, "*") and key not in scanner.masked(around, "*")
    for text in (f"example_{key}", f"{key}_0123456789", f"{key}xxxxxxxx{key}", f"my-Example-{key}"):
        assert key not in scanner.masked(text, "*"), text
    letters = "abcdefghijklmnopqrstuvwxyz"
    for text in (f"{letters.upper()}{letters}0123456789+/", "xxxxxxxxxxxxxxxxxxxxxxxx1234", "example-of-a-plain-words-slug-2024"):
        assert scanner.spans(text) == [], text


@pytest.mark.parametrize("text", [
    "QUJD" + "A" * 30 + "Zq8vT1xKp3Lm9RbW5nYc7HdJ2sFg", "0" * 25 + "ff", "=" * 24 + "v2x", "_" * 22 + "section1a2", "=-" * 5000 + "1a",
    *("A" * n + "x1/9Zq8vT1xKp3Lm9Rb" for n in range(19, 61))])
def test_runs_of_one_character_do_not_stop_a_scan(text):
    began = time.monotonic()
    assert {c for _, s, e in secret_scan.Scanner().spans(text) for c in range(s, e)} <= set(range(len(text)))
    assert time.monotonic() - began < 1


def test_fixed_secrets_equal_a_plain_reading():
    rng = random.Random(8)
    parts = ["password", "Api_Key", "TOKEN", "secret", " ", ":", "=", "'", '"', "AKIA", "Z9", "a1b2c3d4", "ffffffff", "\n", "é", "-", "longvalue1"]
    words = "password passwd secret token api_key apikey".split()
    value = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

    def run(text, at, allowed):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        return end

    def assign(text, at):
        """The ends that the pattern may take from ``at`` on; a match always exists or not at all."""
        for word in words:
            if text[at:at + len(word)].lower() == word:
                i = at + len(word)
                i += text[i:i + 1] in ("'", '"')
                i = run(text, i, {" "})
                if text[i:i + 1] not in (":", "="):
                    continue
                i = run(text, i + 1, {" "})
                i += text[i:i + 1] in ("'", '"')
                if run(text, i, value) > i:
                    return i, run(text, i, value)

    for _ in range(400):
        text, expected, at = "".join(rng.choice(parts) for _ in range(40)), [], 0
        while at < len(text):
            found = assign(text, at)
            if found and found[1] - found[0] >= 8:
                expected.append(("assign", at, found[1]))
            at = found[1] if found else at + 1
        for kind, head, allowed, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 16), ("hex", "", set("0123456789abcdef"), 32)):
            at = 0
            while at < len(text):
                end = run(text, at + len(head), allowed)
                hit = text.startswith(head, at) and end > at + len(head)
                if hit and end - at >= least:
                    expected.append((kind, at, end))
                at = end if hit else at + 1
        spans = [s for s in secret_scan.Scanner().spans(text) if not s[0].startswith("entropy")]
        assert sorted(spans) == sorted(expected), text


def test_window_entropy_equals_counting_anew():
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("aab01234xyz") for _ in range(60))
        covered = set()
        for i in range(41):
            shares = [n / 20 for n in Counter(text[i:i + 20]).values()]
            if -sum(p * np.log2(p) for p in shares) >= 2.9:
                covered |= set(range(i, i + 20))
        assert {i for s, e in secret_scan.window_entropy_spans(text, 20, 2.9) for i in range(s, e)} == covered


def test_urls(spark):
    urls = [(1, "http://WWW.Example.com/en/a?x"), (2, "https://a.example.com/en/"), (3, "x://b.net/fr/1#t"), (4, None), (5, "no url"),
            (6, "http://com"), (7, "http://other.org/en/"), (8, "http://a.com/x")] + [(100 + i, "http://bad.net/es/p") for i in range(30)] + [
            (200, "http://bad.net/en/"), (201, "http://bad.net/en/")]
    rows = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(urls, "page_id bigint, url string")).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert [rows[i].rule for i in (2, 3, 6, 8)] == ["example.com/en/", "net/fr/", None, "com/"]
    assert (rows[4].host, rows[4].path, rows[5].host) == ("", "", "")
    assert rows[200].verdict == rows[201].verdict == "block" and rows[7].verdict == "allow"
    assert url_filter.judge(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_pages_without_a_rule_are_trials(spark):
    urls = [f"http://{host}.net/{path}/" for host, bad, clean in (("mostly-bad", 40, 4), ("mostly-clean", 4, 40), ("half", 20, 20))
            for path in ["es"] * bad + ["en"] * clean]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    open_ones = url_filter.judge(pages).where("rule IS NULL").select("host", "verdict").distinct().collect()
    assert {tuple(r) for r in open_ones} == {("mostly-bad.net", "block"), ("mostly-clean.net", "allow"), ("half.net", "allow")}
    with_null = pages.unionByName(spark.createDataFrame([(None, None), (1000, "")], "page_id bigint, url string"))
    assert url_filter.judge(with_null).count() == len(urls) + 2


def test_substrings(docs, empty):
    n = 35
    count = Counter()
    split = {d: space_words(t) for d, t in TEXTS.items()}
    for w in split.values():
        count.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    rows = substring_dedup.without_repeats(docs).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        w = split[row.doc_id]
        gone = {j for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        assert (row.n_words, row.n_removed) == (len(w), len(gone)), row.doc_id
        assert row.kept_text == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert substring_dedup.without_repeats(empty).count() == 0


def test_languages(spark, empty):
    rng = random.Random(1)
    words_of = {"en": ["the", "of", "with", "thing"], "de": ["der", "und", "schön", "nicht"]}
    rows = [(i, " ".join(rng.choice(words_of[lang]) for _ in range(30)), lang) for i, lang in enumerate(["en", "de"] * 40)]
    train = spark.createDataFrame(rows + [(900, None, "en"), (901, "the", None)], "doc_id bigint, text string, lang string")
    model = language_id.train(train)
    test = spark.createDataFrame([(1, "nicht und der", 0.5), (2, "with the thing", 0.5), (3, None, 0.5), (4, "12 ...", 0.5), (5, "", 0.5)],
                                 "doc_id bigint, text string, score double")
    found = {r.doc_id: r for r in language_id.identify(spark, test, model).collect()}
    assert [found[i].lang_pred for i in range(1, 6)] == ["de", "en", "und", "und", "und"]
    assert all(0 <= r.score <= 1 for r in found.values())
    none = language_id.identify(spark, test, language_id.train(empty)).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_likelihood(docs, empty):
    train = {d for d in TEXTS if d % 3}
    tokens = {d: [w.translate(LOWER) for w in space_words(t)] + [None] for d, t in TEXTS.items()}
    count = Counter(w for d in train for w in tokens[d])
    total = sum(count.values())
    below = total + 0.5 * (len(count) + 1)
    one = {r.doc_id: r for r in lm_scoring.scored(docs, "doc_id % 3 <> 0").collect()}
    for d, row in one.items():
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(tokens[d]), sum(count[w] > 0 for w in tokens[d]), total)
        assert row.base_score == pytest.approx(sum(log10((count[w] + 0.5) / below) for w in tokens[d]))
        assert row.score < 0 and row.held_out == (d not in train)
    parts = {r.doc_id: r.score for r in lm_scoring.scored(docs.unionAll(docs.where("doc_id = 5")), "doc_id % 3 <> 0", max_part=1).collect()}
    assert len(parts) == len(one)
    assert lm_scoring.scored(empty, "true").count() == 0


def test_pairs_found_once_count(spark):
    """Of two texts of the same words, the one whose pairs were found once is likelier."""
    train = [(i, f"left{i} right{i}") for i in range(20)] + [(20 + i, "the cat sat") for i in range(20)]
    rows = [*train, *((100 + i, f"left{i} right{i}") for i in range(20)), *((200 + i, f"left{i} right{(i + 1) % 20}") for i in range(20))]
    found = {r.doc_id: r for r in lm_scoring.scored(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id < 100").collect()}
    assert sum(found[100 + i].score > found[200 + i].score + 0.1 for i in range(20)) >= 18
    assert all(found[100 + i].base_score == pytest.approx(found[200 + i].base_score) for i in range(20))


def test_filter_levels():
    entries = np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    wanted = (np.arange(len(entries)) % 5).astype(np.uint8)
    bits = np.zeros((3, lm_scoring.SEGMENT_BYTES), np.uint8)
    for entry, level in zip(entries, wanted):
        for at in range(1, int(level) + 1):
            for place in lm_scoring.places(np.array([entry]), at):
                bits[int(np.array([entry]).view(np.int64)[0] % 3), place[0] >> 3] |= 1 << (place[0] & 7)
    found = np.zeros(len(entries), np.uint8)
    lm_scoring.levels(entries, bits, 0, 3, found)
    assert (found >= wanted).all() and (found == wanted).mean() > 0.98


def test_packing(docs, spark, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for limits in ({}, {"max_tokens": 64, "max_segments": 3, "max_loss": 40, "prompt_column": "n"}):
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for r in packing.pack(docs, path, **limits).collect():
            by_doc[r.doc_id].append(r)
            by_sequence[r.sequence_id].append(r)
        assert set(by_doc) == set(TEXTS)
        for d, text in TEXTS.items():
            ids, at = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4"), 0
            for r in sorted(by_doc[d], key=lambda r: r.start):
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
                at += r.length
            assert at == len(ids)
        for rows in by_sequence.values():
            at = loss = 0
            for r in sorted(rows, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
                loss += max(0, r.start + r.length - max(r.start, r.doc_id))
            assert at <= limits.get("max_tokens", 4096) and len(rows) <= limits.get("max_segments", 512)
            assert not limits or loss <= limits["max_loss"]
    assert packing.pack(empty, path).count() == 0


def test_plain_words_encode_like_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(2)
    letters = "aZ é É ß İ Σς ſ K ’ ' . , ;… \u0301 \u0085 漢 1 ½ <| endoftext |> don't I'LL x\t\n\x1c $ ﬁ ǅ ÿ Ÿ µ ª"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["<|endoftext|> a<|startoftext|>b"]
    tokenizer = Tokenizer.from_file(path)
    for text, ids in zip(texts, packing.WordIds(path, 2).rows(pa.array(texts))):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [2], text


@pytest.mark.parametrize("block_chars", [1_000_000, 200])
def test_contamination(docs, spark, empty, block_chars):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    items = [(1, " ".join(TEXTS[5].split()[10:30])), (2, "TWO-two"), (3, None), (4, "..."), (10, TEXTS[17]), (11, "one"), (12, "absent words")]
    windows = defaultdict(set)
    for key, text in items:
        w = split(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])].add(str(key))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.digest(decontaminate.contamination(docs, bench, block_chars=block_chars)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        w, hit, found = split(TEXTS[r.doc_id]), set(), set()
        for window, keys in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found |= keys
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(found), bool(hit)), r.doc_id
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.where("false")).where("size(hits) > 0").count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (50, 40), (40, 50)]
    rows = components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in rows} == {**{i: 0 for i in range(1, 31)}, **{i: 100 for i in range(101, 140)}, 50: 40}


def test_jaccard_groups(docs, empty):
    sets = {}
    for d, text in TEXTS.items():
        w = space_words((text or "").translate(LOWER))
        sets[d] = {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    root = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if v == old else v for k, v in root.items()}
    rows = jaccard_join.similar_groups(docs.unionAll(docs.where("doc_id = 6"))).collect()
    assert len(rows) == len(TEXTS) + 1
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {d: (len(sets[d]), root[d]) for d in sets}
    assert jaccard_join.similar_groups(empty).count() == 0


def test_automata_find_one_error():
    terms = ["idiot", "moron", "bad"]
    near = {"idiot": 0, "idiott": 1, "idot": 1, "idxot": 1, "xidiot": 1, "bad": 0, "bed": None, "morons": 1, "idoit": None, "m": None}
    found = {}
    for term, exact, one in toxicity.intersect(toxicity.trie(terms), terms, list(near)):
        found |= {list(near)[i]: 0 for i in exact} | {list(near)[i]: 1 for i in one}
    assert found == {w: d for w, d in near.items() if d is not None}


def test_toxicity(spark, empty, monkeypatch):
    rng = random.Random(4)
    plain = ["river", "stone", "cloud", "green", "walk", "table"]
    rows = [(i, " ".join(rng.choice(plain + (["idiot", "moron"] if i % 4 == 0 else [])) for _ in range(40)), int(i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    test = [(1, "you idiott moron green"), (2, "green table cloud"), (3, None), (4, ""), (5, 'green “idiot” table')]
    found = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(test, "doc_id bigint, text string"), model).collect()}
    assert [found[i].predicted for i in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert found[5].score < found[1].score and all(0 <= r.score <= 1 for r in found.values())
    monkeypatch.setattr(toxicity, "BROADCAST_IDS", 10)  # texts and labels are shuffled together
    shuffled = toxicity.train(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert shuffled.lexicon.terms == model.lexicon.terms and np.allclose(shuffled.coefficients, model.coefficients)
    none = toxicity.train(empty.select("doc_id", "text"), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert toxicity.score(empty.select("doc_id", "text"), none).count() == 0


def test_lexicon_does_not_depend_on_the_number_of_rows(spark):
    """Terms in four of 6000 toxic documents are learned, however many they are."""
    rare = [f"rare{i}" for i in range(4100)]
    row = lambda i: (f"text {'idiot' if i % 2 else 'river'}" + (" " + " ".join(rare) if i in (1, 3, 5, 7) else ""), i % 2)
    rows = spark.createDataFrame([row(i) for i in range(12_000)], "text string, toxic int")
    lexicon = toxicity.learn_lexicon(rows)
    assert set(lexicon.terms) == {"idiot", *rare}
    texts = pa.array(["rare17 and rare4099", "“rare3” rare40x0", "river", None])
    assert np.array_equal(toxicity.Matcher(lexicon).features(texts), toxicity.Matcher(lexicon, block=500).features(texts))


def test_pipeline_drops_near_copies_from_four_fifths(spark):
    import corpus_pipeline

    base = [f"word{i}" for i in range(100)]
    rows = [(1, " ".join(base)), (2, " ".join(base + [f"new{i}" for i in range(20)])),  # 96 of 116 shingles
            (3, " ".join(base + [f"more{i}" for i in range(24)]))]  # exactly 96 of 120
    rows.append((4, " ".join(base + [f"other{i}" for i in range(25)])))  # 96 of 121
    kept = corpus_pipeline.keep_one_of_a_group(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "")
    assert {r.doc_id for r in kept.collect()} == {1, 4}


def test_pipeline(docs, spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    rows = docs.select("doc_id", "text", "lang", "n").union(spark.createDataFrame([(50, "Token: 'abcdefgh12' nicht und der", "fr", 1)], "doc_id bigint, text string, lang string, n int"))
    kept = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == rows.columns, name
    found = {r.doc_id: r.text for r in kept.collect()}
    assert not {0, 1, 2, 6, 7, 9} & set(found) and {5, 12} <= set(found)
    assert "abcdefgh12" not in found.get(50, "")


def test_pipeline_keeps_clashing_columns_and_judges_rows_without_an_id(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").where("length(text) > 100").first().text
    base = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", F.lit("mine").alias("found_lang"), F.lit(1).alias("Found_Score"))
    rows = base.union(spark.createDataFrame([(None, bench, "en", "leak", 1)], base.schema))
    known = corpus_pipeline.keep_known_languages(spark, rows, folder)
    assert known.columns == rows.columns and known.where("found_lang = 'mine'").count() > 0
    kept = corpus_pipeline.drop_contaminated(spark, rows, folder)
    assert kept.columns == rows.columns and kept.where("found_lang = 'leak'").count() == 0 < kept.count()


def test_rows_without_an_id_are_judged_in_place(spark):
    item = " ".join(f"word{i}" for i in range(12))
    rows = [(None, f"before {item} after", 1), (None, "clean text", 2), (3, None, 3), (3, item.upper(), 4), (4, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, found_lang int")
    items = spark.createDataFrame([(1, item), (2, None), (None, "another item of quite a few words that nobody has written yet")], "item_id bigint, text string")
    for block_chars in (10, 1 << 20):
        kept = decontaminate.without_contaminated(docs, items, block_chars=block_chars)
        assert kept.columns == docs.columns and sorted(r.found_lang for r in kept.collect()) == [2, 3, 5]
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == 5
