"""The Merkle manifest, benchmark phrases and spelling variants against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowengine.llm import decontamination, fm_index, merkle, spelling

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


# ---- Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, fanout):
    """The root, and the (left, right) siblings of every leaf."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            start = at[i] // fanout * fanout
            run = nodes[start:start + fanout]
            path.append((run[:at[i] - start], run[at[i] - start + 1:]))
            at[i] //= fanout
        nodes = [sha("".join(nodes[s:s + fanout])) for s in range(0, len(nodes), fanout)]
    return nodes[0], paths


def leaf_of(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def manifest_by_hand(rows, fanout):
    of = collections.defaultdict(list)
    for row in rows:
        text, marked = row["text"], row["doc_id"] is not None
        if marked and text is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
            text = text.translate(LOWER)
        of[row["source"]].append((row["doc_id"], leaf_of(row, row["text"]), leaf_of(row, text)))
    sources = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        of[source].sort(key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))
        trees[source] = tree([leaf for _, leaf, _ in of[source]], fanout)
    if not sources:
        return []
    root, tops = tree([trees[s][0] for s in sources], fanout)
    out = []
    for source, top in zip(sources, tops, strict=True):
        subroot, paths = trees[source]
        for (doc_id, leaf, claimed), path in zip(of[source], paths, strict=True):
            proof = sha("".join("".join(a + b) for a, b in path + top))
            for left, right in path + top:
                claimed = sha("".join(left) + claimed + "".join(right))
            out.append((doc_id, leaf, subroot, root, proof, claimed, claimed == root))
    return out


def manifest_of(documents, fanout, levels):
    copied = merkle.tampered_text(F.col("doc_id"), F.col("text"))
    leaves = documents.select(
        "doc_id", "source", merkle.leaf().alias("digest"),
        merkle.leaf(text=copied).alias("claimed"),
    )
    return merkle.manifest(leaves, fanout, levels)


@pytest.mark.parametrize(
    ("fanout", "levels", "sizes"),
    [(2, 1, [1, 5, 19, 64, 2]), (3, 2, [200, 9, 10, 1, 81, 82]), (16, 3, [50, 4097]), (4, 1, [1])],
)
def test_manifest_by_brute_force(spark, fanout, levels, sizes):
    """One leaf, whole and ragged trees, several blocks, a null source, equal and null ids."""
    draw = random.Random(1)
    rows = [
        {
            "doc_id": draw.choice([None, 5, 5, draw.randrange(10**6), j]),
            "text": draw.choice([None, "", "Abc XYZ É", f"T{j}"]), "lang": None,
            "source": None if i == 1 else f"s{i}", "n_chars": draw.choice([None, 3]),
        }
        for i, size in enumerate(sizes) for j in range(size)
    ]
    blocks = manifest_of(spark.createDataFrame(rows, DOCUMENT).repartition(7), fanout, levels)
    got = merkle.verified(blocks, fanout, levels).collect()
    assert in_order(got) == in_order(manifest_by_hand(rows, fanout))
    for source, doc_id, leaf, path in merkle.proofs(blocks, fanout, levels).limit(20).collect():
        for left, right in path:
            leaf = sha(left + leaf + right)
        assert leaf == got[0].root


def test_manifest_of_awkward_and_of_no_documents(awkward, nothing):
    columns = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    rows = [r.asDict() for r in columns.collect()]
    got = merkle.verified(manifest_of(awkward, 16, 3)).collect()
    assert in_order(got) == in_order(manifest_by_hand(rows, 16))
    assert merkle.verified(manifest_of(nothing, 16, 3)).count() == 0


def test_exchange_hands_every_block_the_whole_path(spark):
    """Ragged numbers of blocks: stand-ins serve those that have no partner of their own."""
    for blocks in (1, 2, 15, 16, 17, 18, 256, 257, 273):
        roots = [sha(str(k)) for k in range(blocks)]
        rows = spark.createDataFrame(
            [("t", k, blocks, r) for k, r in enumerate(roots)],
            "tree string, block long, blocks long, root string",
        )
        root, paths = tree(roots, 16)
        got = {r.block: r for r in merkle._exchanged(rows, 16).collect()}
        assert len(got) == blocks and {r.root for r in got.values()} == {root}
        for k, path in enumerate(paths):
            assert [tuple(s) for s in got[k].path] == [("".join(a), "".join(b)) for a, b in path]


# ---- benchmark phrases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def phrases_by_hand(texts, items, window):
    of = collections.defaultdict(set)
    for item, text in items:
        words = words_of(text)
        for start in range(max(1, len(words) - window + 1) if words else 0):
            of[tuple(words[start:start + window])].add(item)
    out = []
    for text in texts:
        words = words_of(text)
        hit, named = set(), set()
        for length in {len(p) for p in of}:
            for start in range(len(words) - length + 1):
                owners = of.get(tuple(words[start:start + length]))
                if owners:
                    named |= owners - {None}
                    hit.update(range(start, start + length))
        out.append((len(words), len(hit), sorted(map(str, named))))
    return out


def searched(texts, items, window):
    parts = [(None if i is None else str(i), words_of(t)) for i, t in items]
    parts = [p for p in parts if p[1]]
    table = pa.table({
        "item": pa.array([p[0] for p in parts], pa.string()),
        "words": pa.array([p[1] for p in parts], pa.list_(pa.string())),
    })
    phrases = decontamination._phrases(table, window)
    batch = decontamination._Texts(pa.array(texts, pa.string()))
    hit, rows, found = decontamination._searched(batch, phrases, window)
    names = [[] for _ in texts]
    for row, item in zip(rows.tolist(), found.tolist(), strict=True):
        names[row].append(phrases.names[item])
    edges = batch.first_words
    return [
        (int(edges[k + 1] - edges[k]), int(hit[edges[k]:edges[k + 1]].sum()), sorted(names[k]))
        for k in range(len(texts))
    ]


def random_cases(seed, trials):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "é", "漢字", "x1", "long" * 3, "Zz", "9"]
    for _ in range(trials):
        pool = vocabulary[:draw.choice([2, 3, 8])]

        def text(n):
            gaps = (draw.choice([" ", ".", "\n", " _ "]) for _ in range(n))
            return "".join(draw.choice(pool) + gap for gap in gaps)

        texts = [draw.choice([None, "", text(draw.randrange(60)), text(5)]) for _ in range(8)]
        items = [(draw.choice([None, 1, 2, 10]), draw.choice([None, "", text(6), text(14)]))
                 for _ in range(6)] + [(3, "a B")]
        yield texts, items, draw.choice([1, 2, 3, 10])


def test_phrases_by_brute_force(monkeypatch):
    """Small shards too, so that texts are cut and overlap."""
    for k, (texts, items, window) in enumerate(random_cases(3, 120)):
        monkeypatch.setattr(decontamination, "SHARD_SYMBOLS", [1 << 20, 40, 64][k % 3])
        assert searched(texts, items, window) == phrases_by_hand(texts, items, window)


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    real = decontamination.hashes
    monkeypatch.setattr(decontamination, "hashes", lambda *a: real(*a) & np.uint64(0xFFFFF))
    for texts, items, window in random_cases(4, 20):
        assert searched(texts, items, window) == phrases_by_hand(texts, items, window)


def test_index_finds_all_places_of_all_substrings():
    draw = random.Random(5)
    for _ in range(30):
        symbols = [draw.choice([0, 1, 1, 2, 3]) for _ in range(draw.randrange(1, 80))] + [0]
        symbols = np.array(symbols)
        index = fm_index.Index(symbols, 3)
        for length in (1, 2, 3, 7):
            ids = np.array([draw.choice([1, 1, 2, 3]) for _ in range(length)])
            found, low, high = index.search(ids, np.array([0]), np.array([length]))
            want = [k for k in range(len(symbols)) if list(symbols[k:k + length]) == list(ids)]
            got = sorted(index.locate(np.arange(low[0], high[0]))) if len(found) else []
            assert got == want


def test_long_words_and_texts_are_hashed_whole(monkeypatch):
    long = "x" * 3_000_000
    texts = [f"{long} b c", f"{long}y b c", " ".join(f"w{k}" for k in range(400_000)) + " b c"]
    items = [(1, f"{long} b"), (2, "w399999 b c"), (3, "c b")]
    assert searched(texts, items, 3) == phrases_by_hand(texts, items, 3)


def test_find_in_passes_and_cut(spark, awkward, nothing):
    items = spark.createDataFrame(
        [(1, "the SAME old line of words"), (2, "old line"), (2, "le texte est"), (3, None),
         (None, "any id at"), (4, " .,"), (5, "word59998 of word59999 of")],
        "item_id long, text string",
    )
    want = phrases_by_hand(
        [r.text for r in awkward.collect()], [tuple(r) for r in items.collect()], 10
    )
    ids = [r.doc_id for r in awkward.collect()]
    want = in_order((i, *w) for i, w in zip(ids, want, strict=True))
    for block_words in (decontamination.BLOCK_WORDS, 5):
        found = decontamination.find(awkward, items, block_words=block_words)
        assert in_order(found.select("doc_id", "n_words", "n_hit", "items").collect()) == want
    cut = decontamination.decontaminated(awkward, items)
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (1, "the same old line of words again\nand one more line of its own".replace(
        "the same old line of words", "")) in texts
    assert (3, None) in texts and (9, "ends with blanks   ") in texts
    assert decontamination.find(cut, items).where("n_hit > 0").count() == 0
    assert decontamination.find(nothing, items).count() == 0
    none = decontamination.find(awkward, items.where("false")).collect()
    assert [r.n_hit for r in none] == [0] * len(want)
    assert sorted(r.n_words for r in none) == sorted(w[1] for w in want)


# ---- spelling variants

def counted_by_hand(documents, noise=None, least=6):
    n = collections.Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return n


def variants_by_hand(n, times=5):
    near, masks = collections.defaultdict(set), collections.defaultdict(list)
    for word in n:
        for j in range(len(word)):
            masks[word[:j], word[j + 1:]].append(word)
            shorter = word[:j] + word[j + 1:]
            if shorter in n:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in masks.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= times * n[word]:
            form[word] = best
    out = []
    for word in n:
        root = word
        while root in form:
            root = form[root]
        own = form.get(word)
        out.append((word, own, root, n[word], len(near[word]), n[own] if own else None))
    return in_order(out)


def test_words_are_counted_with_noise(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    for noise in (None, 3):
        got = spelling.count_words(awkward, 4, noise)
        assert {r.word: r.n for r in got.collect()} == counted_by_hand(rows, noise, 4)
    assert spelling.count_words(nothing).count() == 0


@pytest.mark.parametrize("letters", ["ab", "abé漢😀"])
def test_variants_by_brute_force(spark, letters):
    """Short and very long words, ties, chains of forms; filters in several passes."""
    draw = random.Random(letters)
    n = {
        "".join(draw.choice(letters) for _ in range(draw.choice([1, 2, 3, 5, 70]))):
            draw.choice([1, 2, 5, 7, 40, 300, 9000])
        for _ in range(120)
    }
    long = "x" * 70_000
    n |= {long: 9, long + "y": 1, long[:-1]: 80}
    rows = [*n.items(), (None, 3)]
    vocabulary = spark.createDataFrame(rows, "word string, n long")
    got = spelling.variants(vocabulary, filter_bytes=1 << 17)
    assert in_order(got.collect()) == variants_by_hand(n)


def test_no_words_have_no_variants(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).collect() == []


def test_filters_hold_all_words_and_few_others():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 1 << 63, 40_000).astype(np.uint64)
    layout = spelling._Layout({9: 20_000, 10: 20_000})
    bits = np.zeros((layout.segments * spelling.SEGMENT_BLOCKS, 8), dtype=np.uint32)
    for lane in range(8):
        np.bitwise_or.at(
            bits[:, lane], layout.block(keys[:20_000], 9), spelling._lane_bits(keys[:20_000], lane)
        )
    found = np.ones(40_000, dtype=bool)
    for lane in range(8):
        found &= bits[layout.block(keys, 9), lane] & spelling._lane_bits(keys, lane) != 0
    assert found[:20_000].all() and found[20_000:].mean() < 0.01
