"""Tokens, languages, fingerprints, lines, mixes and the pipeline against brute force."""

import collections
import hashlib
import itertools
import math
import random
import struct
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowengine.llm import (
    bpe,
    common,
    language_id,
    line_templates,
    quality,
    queries,
    simhash,
    source_mixing,
    token_counts,
    url_filter,
)
from flowengine.llm.components import components

SF = "/root/testdata/sf0.01"
PATH = queries.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
DOCUMENTS = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


# ---- tokens

ODD = st.text(alphabet=" \n\t\r\x1c\x85\xa0\u2028'sthe12²½é漢😀<|endoftx>!.,", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(ODD, st.just("<|endoftext|>"), st.text(max_size=10)), max_size=4))
def test_encoder_and_counter_agree_with_the_library(parts):
    text = "".join(parts).replace("\ud800", "")
    want, own = ids_of(text), bpe.model(PATH).encode(text)
    assert own == packed(want)
    assert token_counts._counter(PATH).count(text) == len(want)
    assert bpe.model(PATH).decode(own) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(ODD, st.integers(1, 9))
def test_parts_of_a_text_join_to_it_and_cost_no_token(text, size):
    parts = list(common.windows(text, size))
    assert "".join(parts) == text == "".join(common.pieces(text))
    plain = text.replace("<", "")
    assert sum(len(ids_of(p)) for p in common.windows(plain, size)) == len(ids_of(plain))


def test_counts_of_all_documents(spark):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit)
           for r in queries.op5_token_counts(spark, SF).collect()}
    want = {}
    for i, text, _ in DOCUMENTS:
        n = len(ids_of(text))
        want[i] = (len((text or "").encode()), n, n > 1024)
    assert got == want


def test_round_trip_of_all_documents(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_bpe_round_trip(spark, SF).collect()}
    want = {}
    for i, text, _ in DOCUMENTS:
        ids = ids_of(text)
        want[i] = (len(ids), hashlib.sha256(packed(ids)).hexdigest(),
                   hashlib.sha256((text or "").encode()).hexdigest())
    assert got == want


def test_awkward_texts(spark, awkward, nothing):
    texts = [r.text for r in awkward.collect()]
    counted = token_counts.count_tokens(awkward, PATH)
    assert sorted(r.n_tokens for r in counted.collect()) == sorted(len(ids_of(t)) for t in texts)
    decoded = bpe.decode(bpe.encode(awkward, PATH), PATH).collect()
    assert sorted(r.text for r in decoded) == sorted(t or "" for t in texts)
    assert token_counts.count_tokens(nothing, PATH).count() == 0
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).count() == 0


# ---- languages


def test_ngrams_by_definition():
    for _, text, _ in DOCUMENTS[:20]:
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        line = " " + " ".join(words) + " "
        want = collections.Counter()
        for at, size in itertools.product(range(len(line)), (1, 2, 3)):
            gram = line[at:at + size]
            if len(gram) == size and gram != " " and not (size == 3 and gram[1] == " "):
                want[sum(ord(c) << 21 * k for k, c in enumerate(reversed(gram)))] += 1
        codes, counts = language_id.ngrams(text)
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == want


def test_ngrams_in_windows(monkeypatch):
    whole = [x.tolist() for x in language_id.ngrams(DOCUMENTS[0][1])]
    monkeypatch.setattr(language_id, "WINDOW_CHARS", 7)
    assert [x.tolist() for x in language_id.ngrams(DOCUMENTS[0][1])] == whole


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op6_language_id(spark, SF).collect()}
    assert {i for i, r in rows.items() if r.held_out} == {
        i for i, _, _ in DOCUMENTS if zlib.crc32(str(i).encode()) % 5 == 0
    }
    hits = [rows[i].lang_pred == lang for i, _, lang in DOCUMENTS if rows[i].held_out]
    assert sum(hits) / len(hits) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_profiles_by_brute_force(spark):
    counts = collections.defaultdict(collections.Counter)
    for i, text, lang in DOCUMENTS:
        if zlib.crc32(str(i).encode()) % 5:
            grams, n = language_id.ngrams(text)
            counts[lang].update(dict(zip(grams.tolist(), n.tolist(), strict=True)))
    want = {
        lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:300]]
        for lang, c in counts.items()
    }
    docs = common.table(spark, SF, "documents")
    profiles = language_id.learn(docs.where(~language_id.held_out(F.col("doc_id"))))
    assert profiles == want


def grams_by_hand(text):
    """Of every word between blanks its letters, and its runs of two and three with the blanks."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    counts = collections.Counter()
    for word in words:
        counts.update(word)
        padded = f" {word} "
        for size in (2, 3):
            counts.update(padded[k:k + size] for k in range(len(padded) - size + 1))
    return counts


def profile_by_hand(counts):
    """The 300 most frequent, ties to the shorter and then to the smaller code points."""
    order = sorted(counts, key=lambda g: (-counts[g], len(g), [ord(c) for c in g]))
    return {gram: rank for rank, gram in enumerate(order[:300])}


def test_predictions_by_brute_force(spark):
    """The distance of ranks, the language and the score of every document, without the library's
    own n-grams, profiles or tables."""
    learned = collections.defaultdict(collections.Counter)
    grams = {i: grams_by_hand(text or "") for i, text, _ in DOCUMENTS}
    for i, _, lang in DOCUMENTS:
        if lang is not None and zlib.crc32(str(i).encode()) % 5:
            learned[lang].update(grams[i])
    profiles = {lang: profile_by_hand(counts) for lang, counts in learned.items()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op6_language_id(spark, SF).collect()}
    assert len(got) == len(DOCUMENTS)
    for i, own in grams.items():
        own = profile_by_hand(own)
        if not own:
            assert got[i] == ("und", 0.0)
            continue
        distance = {
            lang: sum(abs(rank - known[g]) if g in known else 300 for g, rank in own.items())
            for lang, known in profiles.items()
        }
        best = min(distance, key=lambda lang: (distance[lang], lang))
        assert got[i][0] == best
        assert got[i][1] == pytest.approx(1 - distance[best] / (300 * len(own)))


def test_a_blank_only_text_and_one_of_one_huge_word(spark):
    """Several megabytes in one word, through every function on texts that has a bound."""
    huge = "ab" * 1_000_000
    frame = spark.createDataFrame(
        [(1, huge), (2, huge), (3, huge[:-1]), (4, " \t\n"), (5, None)], "doc_id long, text string"
    ).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert found[1] == found[2] == 1 and found[3] == 3 and found[4] == found[5] == 4
    rows = {r.doc_id: r for r in bpe.round_trip(frame, PATH).collect()}
    for i, text in ((1, huge), (3, huge[:-1])):
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert rows[i].n_tokens == len(ids_of(text))
        assert rows[i].ids_sha256 == hashlib.sha256(packed(ids_of(text))).hexdigest()
    assert rows[1].ids == rows[2].ids and rows[4].n_tokens == len(ids_of(" \t\n")) and rows[5].n_tokens == 0
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(frame, PATH).collect()}
    assert counts == {i: r.n_tokens for i, r in rows.items()}


def test_languages_of_awkward_texts(awkward, nothing):
    profiles = language_id.learn(awkward)
    assert set(profiles) == {"en", "fr"}
    rows = language_id.predict(awkward, profiles).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert language_id.learn(nothing) == {}
    assert language_id.predict(nothing, {}).count() == 0
    assert {r.lang_pred for r in language_id.predict(awkward, {}).collect()} == {"und"}


# ---- fingerprints


def brute_mark(text, shingle=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(marks, distance):
    """Component root of each mark."""
    root = {m: m for m in marks}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(list(root), 2):
        if (a ^ b).bit_count() <= distance:
            root[find(a)] = find(b)
    return {m: find(m) for m in root}


def check_groups(frame, marks, distance):
    """marks: (doc_id, mark) of each row."""
    got = collections.Counter((r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id)
                              for r in frame.collect())
    roots = brute_groups({m for _, m in marks}, distance)
    smallest = {}
    for i, m in marks:
        if i is not None:
            smallest[roots[m]] = min(i, smallest.get(roots[m], i))
    want = collections.Counter((i, m, smallest.get(roots[m])) for i, m in marks)
    assert got == want


def test_near_duplicates_of_all_documents(spark):
    docs = common.table(spark, SF, "documents")
    check_groups(simhash.near_duplicates(docs), [(i, brute_mark(t)) for i, t, _ in DOCUMENTS], 2)


def test_near_duplicates_of_awkward_texts(awkward, nothing):
    marks = [(r.doc_id, brute_mark(r.text)) for r in awkward.collect()]
    check_groups(simhash.near_duplicates(awkward), marks, 2)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(awkward)
    assert kept.count() == len(set(brute_groups({m for _, m in marks}, 2).values()))
    assert kept.columns == COLUMNS


@pytest.mark.parametrize("leaf", [2, 16])
def test_index_finds_every_link(spark, monkeypatch, leaf):
    import random

    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "FAN", 3)
    draw = random.Random(leaf)
    marks = [draw.getrandbits(64) for _ in range(60)]
    for _ in range(140):
        near = draw.choice(marks)
        for _ in range(draw.randrange(4)):
            near ^= 1 << draw.randrange(64)
        marks.append(near)
    signed = sorted({m - (1 << 64) if m >> 63 else m for m in marks})
    frame = spark.createDataFrame([(m,) for m in signed], "mark long")
    found = components(simhash._within(frame, 2)).collect()
    roots = brute_groups(set(marks), 2)
    sizes = collections.Counter(roots.values())
    got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in found}
    assert set(got) == {m for m in roots if sizes[roots[m]] > 1}
    for a, b in itertools.combinations(got, 2):
        assert (got[a] == got[b]) == (roots[a] == roots[b])


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (41, 41)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- lines


def test_templates_generalise_variable_fields(spark):
    rows = [(k, f"the main office saw user {name} logged in today\nown text {'abcdef'[k] * 5} stays right here")
            for k, name in enumerate(["ann", "bob", "cat", "dan", "eve", "fay"])]
    rows.append((9, "user 77 paid 12 coins to the other user at noon"))
    rows.append((10, "user 5 paid 130 coins to the other user at noon"))
    # seven of ten tokens are fixed, which is too few
    rows.append((11, "user 77 paid 12 coins to user 31 at noon"))
    rows.append((12, "user 5 paid 130 coins to user 2 at noon"))
    frame = spark.createDataFrame([(*r, "en", "s", 1) for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(frame).collect()}
    assert got[0].text == rows[0][1]
    assert all(got[k].text == rows[k][1].split("\n")[1] for k in range(1, 6))
    assert all("logged" not in got[k].text for k in range(1, 6))
    assert (got[10].text, got[10].n_dropped) == ("", 1) and got[9].n_dropped == 0
    assert got[11].n_dropped == got[12].n_dropped == 0


def test_lines_of_figures_are_compared_as_they_are(spark):
    """Where tokens with a digit are half of a line or more, only the same figures recur; in a
    crowded leaf they do not count as fixed."""
    texts = {
        1: "1.2 3.4 5.6\n2024-01-05 17:30 A12 B7 ok\n1 2 3 4 5 6 7 8 net x",
        2: "7 8 9\n2023-11-30 08:15 C3 D9 ok\n9 8 7 6 5 4 3 2 net y",
        3: "1.2  3.4 5.6\n2024-01-05 17:30 A12 B7 ok\n1 2 3 4 5 6 7 9 net x",
        4: "page 3 of the old book\nown words only in this text",
        5: "page 17 of the old book\nother words of the last text",
    }
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts.items()],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(frame).collect()}
    assert {k: got[k] for k in (1, 2, 4)} == {k: texts[k] for k in (1, 2, 4)}
    assert got[3] == "1 2 3 4 5 6 7 9 net x" and got[5] == "other words of the last text"


def dropped_lines(spark, texts):
    frame = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in texts.items()],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    rows = line_templates.drop_recurring_lines(frame).collect()
    return {r.doc_id: r.n_dropped for r in rows if r.n_dropped}


def test_lines_with_different_contents_stay(spark):
    """Too few fixed tokens, in a line alone as well as in a crowded leaf."""
    line = "total cost of item {} {} {} shown"
    assert dropped_lines(spark, {1: line.format(12, 13, 14), 2: line.format(98, 97, 96)}) == {}
    many = {k: line.format(k, k + 1, k + 2) for k in range(20)}
    assert dropped_lines(spark, many) == {}


def test_more_lines_in_a_leaf_hide_none(spark):
    """Each differs from the first in another field; unrelated lines share the leaf."""
    words = "the red fox ran over one low hill last night".split()

    def variant(at, word):
        return " ".join(word if k == at else w for k, w in enumerate(words))

    texts = {1: " ".join(words), 2: variant(5, "that"), 3: variant(8, "this"), 4: variant(4, "up")}
    assert dropped_lines(spark, texts) == {2: 1, 3: 1, 4: 1}
    others = {
        100 + k: "the red fox " + " ".join(f"{c}{j}x".replace(str(j), "abcdefg"[j]) for j in range(7))
        for k, c in enumerate("klmnopqrst")
    }
    assert dropped_lines(spark, others | texts) == {2: 1, 3: 1, 4: 1}


def test_lines_against_all_pairs(spark):
    """Random lines with one to four changed words, in crowded leaves."""
    draw = random.Random(8)
    texts = {}
    for k in range(150):
        n = draw.choice([3, 5, 6, 10, 16, 25])
        words = ["in", "the", "end"] + [f"w{'abcdefghij'[j % 10]}{'xyz'[n % 3]}" for j in range(n - 3)]
        for _ in range(draw.randrange(4)):
            if n > 3:
                words[draw.randrange(3, n)] = draw.choice(["one", "two", "7", "x9", "three"])
        texts[k] = " ".join(words)

    def masked(text):
        return ["<*>" if any(c.isdigit() for c in w) else w for w in text.split()]

    def fixed(a, b):
        return sum(x == y != "<*>" for x, y in zip(a, b, strict=True))

    want = {}
    for k, text in texts.items():
        own = masked(text)
        for j in range(k):
            other = masked(texts[j])
            if text == texts[j] or (
                len(own) == len(other) and own[:3] == other[:3]
                and fixed(own, other) >= 0.8 * len(own)
            ):
                want[k] = 1
    assert dropped_lines(spark, texts) == want


def first_likes(texts):
    """For each document of one line of words, whether an earlier one is like it: all pairs."""
    def like(a, b):
        a, b = a.split(), b.split()
        same = sum(x == y for x, y in zip(a, b, strict=False))
        return len(a) == len(b) and a[:3] == b[:3] and same >= 0.8 * len(a)

    return {k: 1 for k in texts if any(j < k and like(texts[j], texts[k]) for j in texts)}


def test_unlike_lines_before_hide_no_like(spark, monkeypatch):
    """Earlier lines share every group of a later one, but too few tokens; one in between is like
    it. Long lines have groups of one or two segments."""
    monkeypatch.setattr(line_templates, "GROUP_PART", 4, raising=False)
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts, k = {}, 0
    for n, leaf in ((15, "p"), (20, "q"), (30, "r"), (70, "s")):
        allowed = int(n * 0.2 + 1e-9)
        words = [f"{leaf}{letters[j % 26]}{letters[j // 26]}" for j in range(n)]
        # these keep about half of the line's places, from `start` on, and differ in the others
        for start in range(3, n):
            kept = {(start + j - 3) % (n - 3) + 3 for j in range((n - 3) // 2)} | {0, 1, 2}
            texts[k] = " ".join(w if j in kept else f"x{letters[draw.randrange(26)]}{w}"
                                for j, w in enumerate(words))
            k += 1
        for _ in range(6):
            changed = set(draw.sample(range(3, n), allowed))
            texts[k] = " ".join(f"y{letters[draw.randrange(26)]}" if j in changed else w
                                for j, w in enumerate(words))
            k += 1
        texts[k] = " ".join(words)
        k += 1
    want = first_likes(texts)
    assert len(want) >= 4
    assert dropped_lines(spark, texts) == want


def test_long_lines_without_blanks_recur(spark):
    passage = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。"
    other = passage.replace("猫", "犬")
    texts = {1: f"{passage}\nshort", 2: f"{passage} \nshort", 3: f"{other}\nshort\n{' ' * 40}",
             4: f"{passage}2024年\n{' ' * 40}", 5: f"{passage}2025年"}
    frame = spark.createDataFrame([(k, t, "ja", "s", 1) for k, t in texts.items()],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(frame).collect()}
    assert got == texts | {2: "short"}


def test_lines_of_awkward_texts(awkward, nothing):
    rows = line_templates.drop_recurring_lines(awkward).collect()
    assert len(rows) == awkward.count()
    texts = {(r.doc_id, r.text) for r in rows}
    assert (2, "another line that only this has") in texts and (3, None) in texts and (4, "") in texts
    assert [r.n_dropped for r in rows if r.doc_id == 7] == [0, 0, 0]
    assert line_templates.drop_recurring_lines(nothing).count() == 0


# ---- mixes


def brute_targets(sizes):
    """Targets of sources (name, size) by resharing until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        for s in over or open_:
            target[s] = 2 * sizes[s] if over else weight[s] * level
            left -= target[s]
        open_ -= over or set(open_)
    return target


def check_mix(frame, block_words):
    pieces, shares = source_mixing.mix(frame, block_words)
    rows = shares.collect()
    assert len(rows) == frame.count()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = brute_targets(sizes)
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.taken <= 2 * r.size and r.target == pytest.approx(want[r.source])
    for source, words in taken.items():
        assert abs(words - want[source]) <= 0.5
    slots = collections.defaultdict(int)
    for p in pieces.collect():
        slots[p.slot] += p.last_word - p.first_word
    assert all(n <= block_words for n in slots.values())
    assert sorted(map(str, shares.collect())) == sorted(map(str, rows))


@pytest.mark.parametrize("block_words", [3, 1024])
def test_mix_of_awkward_texts(awkward, nothing, block_words):
    check_mix(awkward, block_words)
    assert source_mixing.mix(nothing)[1].count() == 0
    assert source_mixing.mixed_documents(nothing).count() == 0


def test_schedule_spreads_sources_evenly(spark):
    docs = common.table(spark, SF, "documents")
    pieces, _ = source_mixing.mix(docs, 64)
    slots = {r.slot: r.no for r in pieces.select("slot", "no").distinct().collect()}
    order = [slots[s] for s in sorted(slots)]
    half = len(order) // 2
    first, whole = collections.Counter(order[:half]), collections.Counter(order)
    assert all(abs(first[s] - n / 2) <= 6 for s, n in whole.items())


def test_mixed_documents_hold_the_words_taken(awkward):
    _, shares = source_mixing.mix(awkward)
    words = sum(r.taken for r in shares.collect())
    mixed = source_mixing.mixed_documents(awkward)
    assert mixed.columns == COLUMNS
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == words


# ---- quality and URLs


def test_mix_is_in_the_order_of_the_schedule(spark):
    """Documents come as their first slots do, so sources alternate; a larger share comes oftener."""
    rows = [(k, " ".join(["w"] * 5), "en", "abc"[k % 3], 10) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    pieces, shares = source_mixing.mix(frame, 5)
    first = {}
    for p in pieces.collect():
        first[p.doc_id, p.epoch] = min(p.slot, first.get((p.doc_id, p.epoch), p.slot))
    mixed = source_mixing.mixed_documents(frame, 5).collect()
    order = sorted((slot, doc_id % 3, doc_id) for (doc_id, _), slot in first.items())
    assert [r.doc_id for r in mixed] == [doc_id for *_, doc_id in order]
    changes = sum(a.source != b.source for a, b in itertools.pairwise(mixed))
    assert changes > len(mixed) / 2
    of_shares = {r.doc_id: (r.first_slot, r.n_slots) for r in shares.collect()}
    for k in range(300):
        slots = [s for (doc_id, _), s in first.items() if doc_id == k]
        assert of_shares[k] == (min(slots, default=None), len(slots))


def test_targets_of_many_sources(spark):
    """Numbered and summed up over several partitions."""
    draw = random.Random(6)
    sizes = {f"host{k}": draw.randrange(1, 50) for k in range(400)} | {None: 7, "": 0}
    rows = [(s, n) for s, n in sizes.items()]
    sized = spark.createDataFrame(rows, "source string, size long").repartition(5)
    got = source_mixing.targets(sized).collect()
    want = brute_targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert {r.source: r.no for r in got} == {s: k for k, s in enumerate(order)}
    assert {r.source: r.target for r in got} == pytest.approx(want)


def test_quality_separates_the_labelled(spark):
    rows = {r.doc_id: r.kept for r in queries.op7_quality(spark, SF).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
    hits = [rows[i] == (q == 1) for i, q in labels]
    assert sum(hits) / len(hits) > 0.97


def by_hand(frame, labels):
    """(quality, good) of the labelled documents of a frame that are not in `labels`."""
    rows = quality.score(frame, labels).join(
        frame.select("doc_id", F.col("good").alias("truth")), "doc_id"
    )
    known = {r.doc_id for r in labels.collect()}
    return [(r.quality, r.truth) for r in rows.where("truth IS NOT NULL").collect()
            if r.doc_id not in known]


def log_loss(judged):
    return -sum(math.log(q if good else 1 - q) for q, good in judged) / len(judged)


def test_quality_of_held_out_documents(spark):
    """A fifth of the labels is not learned from; probabilities mean what they say."""
    docs = common.table(spark, SF.replace("0.01", "0.1"), "documents")
    labels = common.table(spark, SF.replace("0.01", "0.1"), "labels")
    frame = docs.join(labels.select("doc_id", F.col("quality").alias("good")), "doc_id").select(
        "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"), "good"
    )
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    judged = by_hand(frame, labels.where(~held_out).select("doc_id", "quality"))
    assert len(judged) > 500
    assert sum((q >= 0.5) == (good == 1) for q, good in judged) / len(judged) > 0.97
    majority = max(sum(g for _, g in judged), sum(1 - g for _, g in judged)) / len(judged)
    assert majority < 0.9 and log_loss(judged) < 0.1
    assert abs(sum(q for q, _ in judged) - sum(g for _, g in judged)) / len(judged) < 0.02


def test_sites_tell_what_texts_do_not(spark):
    """Equal texts on good and bad hosts, and on good and bad paths of one host."""
    draw = random.Random(2)
    shares = {("a", "x"): 0.95, ("b", "x"): 0.1, ("c", "x"): 0.9, ("c", "y"): 0.15, ("d", "z"): 0.8}
    rows = [
        (k, "the same words", host, path, int(draw.random() < share))
        for k, ((host, path), share) in enumerate((s for s in shares.items() for _ in range(160)))
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string, path string, good int")
    labels = frame.where("doc_id % 2 = 0").select("doc_id", F.col("good").alias("quality"))
    nowhere = frame.withColumn("host", F.lit(None).cast("string")).withColumn(
        "path", F.lit(None).cast("string")
    )
    placed, apart = by_hand(frame, labels), by_hand(nowhere, labels)
    assert log_loss(placed) < 0.8 * log_loss(apart)
    # of a sparse site the host decides, of an unknown one all
    more = spark.createDataFrame(
        [(1000, "the same words", "b", "new", 0), (1001, "the same words", "new", "new", 0)], frame.schema
    )
    prior = {r.doc_id: r.prior for r in quality.score(frame.union(more), labels).collect()}
    assert prior[1000] < 0.35 and 0.45 < prior[1001] < 0.75


def test_own_labels_do_not_count(spark):
    rows = [(k, f"text {'!' * (k % 3)} A", "h" if k % 2 else None, f"p{k % 4}") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    given = [(k, int(k % 3 > 0)) for k in range(30)]

    def judged(labels):
        labels = spark.createDataFrame(labels, "doc_id long, quality int")
        return {r.doc_id: r for r in quality.score(frame, labels).collect()}

    # a lone label leaves its document where no label would
    alone = judged([(7, 1)])
    assert (alone[7].evidence, alone[7].prior) == (0.0, 0.5) and alone[9].prior > 0.5
    # contradicting labels both count, for others
    both = judged([(7, 1), (7, 0)])
    assert both[7].prior == 0.5 and both[9].prior == 0.5
    assert len(judged(given)) == 40


def test_quality_ignores_clashing_columns(spark):
    plain = [(k, f"words {'#' * (k % 5)}", "h", "p") for k in range(20)]
    frame = spark.createDataFrame(plain, "doc_id long, text string, host string, path string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, quality int")
    names = ("good", "bad", "cells", "its_id", "its_host", "evidence", "prior", "quality", "sum", "model")
    wide = frame.withColumns({c: F.lit(1) for c in names})
    got = quality.score(wide, labels.withColumns({c: F.lit(1) for c in ("good", "text", "host")}))
    assert sorted(got.collect()) == sorted(quality.score(frame, labels).collect())


def test_quality_of_awkward_texts(spark, awkward, nothing):
    sites = awkward.select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (8, 0), (None, 1), (3, None), (99, 0)],
                                   "doc_id long, quality int")
    rows = quality.score(sites, labels).collect()
    assert len(rows) == awkward.count() and all(0 < r.quality < 1 for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r.evidence, r.prior) for r in quality.score(sites, none).collect()} == {(0.0, 0.5)}
    empty = nothing.select("doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path"))
    assert quality.score(empty, labels).count() == 0


def test_awkward_urls(spark, monkeypatch, tmp_path):
    urls = [
        (1, None, "-", None), (2, "no scheme", "-", None), (3, "", "-", None),
        (4, "http://Www.EXAMPLE.com/en/x?y", "www.example.com/en/", "allow"),
        (5, "http://a.example.com/en/", "example.com/en/", "block"),
        (6, "http://example.com", None, "allow"), (7, "x://fr.net/fr/#a", "net/fr/", "block"),
        (8, "x://notexample.com/en/", "com/", "allow"), (8, "x://net/es/", "net/es/", "block"),
        (None, "x://a.b.org/" + "p" * 100_000, None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u, _, _ in urls],
                                  "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES + [("net", "/es/", "allow"), (None, "/", "block")],
                                  "host string, path string, verdict string")
    for per_file in (url_filter.RULES_PER_FILE, 2):
        rows = url_filter.judge(pages, url_filter.build_index(rules, per_file)).collect()
        got = sorted((str(r.page_id), str(r.rule), r.verdict) for r in rows)
        want = sorted((str(i), str(None if rule in ("-", None) else rule), verdict or "allow")
                      for i, _, rule, verdict in urls)
        assert got == want
        assert {(r.host, r.path) for r in rows if r.page_id in (1, 2, 3)} == {("", "")}
    # one digest for all hosts: only the stored strings tell them apart
    path = str(tmp_path / "index" / "0.bin")
    monkeypatch.setattr(url_filter, "_digests", lambda hosts: np.full(len(hosts), 7, dtype="<u8"))
    for place in (path, f"file:{path}"):  # written again by a task that is repeated
        url_filter._write(place, pa.table({
            "host": ["a", "b"], "path": ["/", "/x"], "verdict": ["allow", "block"]
        }))
        assert url_filter._Index(place).rules(["b", "c"]) == {"b": [("/x", "block")]}
    assert [p.name for p in (tmp_path / "index").iterdir()] == ["0.bin"]
    assert url_filter.judge(pages.limit(0), []).count() == 0


@pytest.mark.parametrize("per_file", [1, 10])
def test_equally_long_rules(spark, per_file):
    """The text later in code-point order decides."""
    rules = spark.createDataFrame(
        [("a.b.c", "/", "block"), ("b.c", "/xy", "allow"), ("b.c", "/xz", "block")],
        "host string, path string, verdict string",
    )
    pages = spark.createDataFrame(
        [(1, "x://a.b.c/xyz"), (2, "x://a.b.c/xz"), (3, "x://a.b.c/x"), (4, "x://b.c/xy")],
        "page_id long, url string",
    )
    rows = url_filter.judge(pages, url_filter.build_index(rules, per_file)).collect()
    got = {r.page_id: (r.rule, r.verdict) for r in rows}
    assert got == {1: ("b.c/xy", "allow"), 2: ("b.c/xz", "block"), 3: ("a.b.c/", "block"),
                   4: ("b.c/xy", "allow")}


# ---- pipeline


def test_stages_and_their_columns(spark, awkward, nothing):
    for start in (awkward, nothing):
        docs = start
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = common.materialised(stage(spark, docs, SF), f"test-{name}")
            if k < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == COLUMNS
        assert docs.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run_against_single_steps(spark):
    """Each stage's result, from its own input, by brute force or the stage's SQL."""
    con = duckdb.connect()
    docs = common.table(spark, SF, "documents")
    found = corpus_pipeline.identify_language(spark, docs, SF)
    # all of these texts have letters and resemble a language
    assert {r.doc_id for r in found.select("doc_id").collect()} == {i for i, _, _ in DOCUMENTS}

    from flowengine.llm import oracles

    lines = common.materialised(corpus_pipeline.drop_lines(spark, found, SF), "test-lines")
    documents = found.toPandas()  # noqa: F841  DuckDB reads it by name
    con.register("documents", documents)
    want = dict(con.execute(f"SELECT doc_id, text FROM ({oracles.oracle_sql()['op3_line_dedup']})").fetchall())
    texts = {r.doc_id: r.text for r in lines.collect()}
    assert texts == want

    one = common.materialised(corpus_pipeline.drop_near_duplicates(spark, lines, SF), "test-one")
    marks = {i: brute_mark(t) for i, t in texts.items()}
    roots = brute_groups(set(marks.values()), 2)
    firsts = {}
    for i in sorted(texts):
        firsts.setdefault(roots[marks[i]], i)
    kept = {r.doc_id: r.text for r in one.collect()}
    assert set(kept) == set(firsts.values())

    mixed = common.materialised(corpus_pipeline.mix_sources(spark, one, SF), "test-mixed")
    con.register("documents", one.toPandas())
    taken = dict(con.execute(
        f"SELECT doc_id, taken FROM ({oracles.oracle_sql()['op4_source_mixing']})").fetchall())
    got = collections.Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(r.text.split())
        assert r.text == kept[r.doc_id] or kept[r.doc_id].split()[:len(r.text.split())] == r.text.split()
    assert +got == collections.Counter({i: n for i, n in taken.items() if n})

    rows = corpus_pipeline.encode(spark, mixed, SF).collect()
    want_ids = collections.Counter((r.doc_id, packed(ids_of(r.text))) for r in mixed.collect())
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in rows) == want_ids
    assert corpus_pipeline.ORACLE_SQL is None
