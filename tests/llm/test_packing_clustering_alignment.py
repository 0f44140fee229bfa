"""Packing, clustering and cross-tokenizer alignment against brute force and the tokenizers' own libraries."""

import hashlib
import itertools
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from helpers import EDGE_TEXTS, SF, documents  # noqa: E402

from perigee.llm import alignment, clustering, packing  # noqa: E402
from perigee.llm.bytebpe import ByteBpe  # noqa: E402
from perigee.llm.common import table, tokenizer_path  # noqa: E402
from perigee.llm.queries import QUERIES  # noqa: E402

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["<|endoftext|> and <|endoftext|>", "</s> <s> <unk> <0x41>", "a ▁ b", "naïve café ﬁ 你好 🤖🤖 ‱", "\x00\x01   x y", "͸\U0001fae9 new signs",
       "  spaces   inside  ", "tabs\tand\n\nlines\r\n", "é combining", "don't we'll I'M"]


# ---- byte-level ids


@pytest.mark.parametrize("literal", [False, True])
def test_byte_ids_are_the_library_s(spark, literal):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A)
    library.encode_special_tokens = literal
    r, bpe = random.Random(3), ByteBpe(A, literal)
    signs = "aZ 09\n\t.'é 你́🤖<|endoftext|>͸ßſ١²"
    texts = [t or "" for t in EDGE_TEXTS] + ODD + ["".join(r.choice(signs) for _ in range(r.randint(0, 60))) for _ in range(2000)]
    texts += [row["text"] for row in table(spark, SF, "documents").filter("text is not null").collect()]
    for t in texts:
        assert bpe.ids(t) == library.encode(t, add_special_tokens=False).ids
        assert b"".join(bpe.bytes_of[i] for i in bpe.ids(t)) == t.encode()


# ---- packing


def test_closest_is_the_best_multiset():
    r = random.Random(5)
    for _ in range(300):
        room = r.randint(0, 24)
        left = [0] + [r.choice([0, 0, 1, 2, 5]) for _ in range(24)]
        sums = {0}
        for length, n in enumerate(left):
            sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
        take = packing.closest(left, room)
        assert all(0 < n <= left[x] for x, n in take.items())
        assert sum(x * n for x, n in take.items()) == max(sums)


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_token_once(seed):
    r = random.Random(seed)
    window = r.choice([1, 2, 16, 64, 1024])
    counts = [0] + [r.choice([0, 0, 1, 3, r.randint(0, 40)]) for _ in range(window - 1)]
    if seed == 0:
        counts = [0] * 1024
        counts[700] = 1000
        window = 1024
    plan = packing.fill(counts, window)
    total = sum(x * n for x, n in enumerate(counts))
    assert plan.windows == -(-total // window)  # no padding but in the last
    taken = np.zeros((plan.windows, window), int)
    length = np.repeat(np.arange(window), counts)
    rank = np.concatenate([np.arange(n) for n in counts] or [[]]).astype(np.int64)
    for _, placed, sequence, offset in plan.place(length, rank):
        for n, s, o in zip(placed, sequence, offset):
            taken[s, o : o + n] += 1
    assert taken.max(initial=0) <= 1 and taken.sum() == total
    assert (np.diff(taken, axis=1) <= 0).all()  # gapless from 0


def test_plan_does_not_grow_with_the_corpus():
    r = random.Random(9)
    counts = [0] + [r.randint(0, 10**9) for _ in range(1023)]
    assert len(packing.fill(counts).rows) < 10_000


def check_pieces(pieces, texts, window):
    """texts: (key, text) of every document."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A)
    wanted = Counter()
    for k, t in texts:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        wanted[k, np.array(ids, "<u4").tobytes()] += 1
    sequences = defaultdict(list)
    by_key = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        by_key[p["doc_id"]].append(p)
        assert len(p["ids"]) == 4 * p["length"] > 0
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in itertools.pairwise(s))
        assert s[-1][0] + s[-1][1] <= window
    tokens = sum(p["length"] for p in pieces)
    assert len(sequences) <= tokens // window + 1
    return wanted, by_key


def test_pieces_of_all_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").repartition(5)
    rows = [tuple(r) for r in docs.collect()]
    wanted, by_key = check_pieces(packing.pack(docs, A, window=256).collect(), rows, 256)
    for (k, ids), n in wanted.items():
        assert n == 1
        pieces = sorted(by_key[k], key=lambda p: p["start"])
        assert b"".join(bytes(p["ids"]) for p in pieces) == ids
        assert [p["start"] for p in pieces] == [0, *itertools.accumulate(p["length"] for p in pieces[:-1])]
        assert {p["doc_tokens"] for p in pieces} == {len(ids) // 4}


def test_packing_of_odd_rows(spark):
    docs = documents(spark, EDGE_TEXTS + ODD)
    pieces = packing.pack(docs, A).collect()
    wanted, by_key = check_pieces(pieces, [(r["doc_id"], r["text"]) for r in docs.collect()], 1024)
    for k in by_key:  # repeated rows share a key: all their tokens are there
        assert sum(p["length"] for p in by_key[k]) == sum(n * len(ids) // 4 for (key, ids), n in wanted.items() if key == k)
    assert packing.pack(docs.limit(0), A).collect() == []
    assert packing.pack(docs, A).columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def test_packing_as_registered(spark):
    rows = QUERIES["op11_packing"](spark, SF).collect()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A)
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    for p in rows:
        ids = [*library.encode(texts[p["doc_id"]], add_special_tokens=False).ids, 0]
        assert p["doc_tokens"] == len(ids)
        assert p["ids_crc32"] == zlib.crc32(np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes())


# ---- clustering


def test_hilbert_order_moves_one_step_at_a_time():
    for dims in (2, 3, 5):
        cells = np.array(list(itertools.product(range(4), repeat=dims)))
        keys = [k.tobytes() for k in clustering.hilbert_keys(cells)]
        assert len(set(keys)) == len(keys)
        way = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(way, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("spread", [3, 400, 2**26])
def test_boxes_keep_the_nearest(spread):
    rng = np.random.default_rng(spread)
    centroids = rng.integers(-spread, spread, (40, 8))
    centroids[7] = centroids[3]
    for _ in range(50):
        block = centroids[rng.integers(40)] + rng.integers(-spread // 3, spread // 3 + 1, (16, 8))
        numbers = clustering.box_candidates(block.min(axis=0), block.max(axis=0), centroids)
        got = clustering.nearest(block, centroids, numbers)
        all_distances = ((block.astype(object)[:, None] - centroids.astype(object)) ** 2).sum(axis=2)
        assert got[0].tolist() == [min(range(40), key=lambda i: (row[i], i)) for row in all_distances]
        assert got[1].tolist() == all_distances.min(axis=1).tolist()


def brute_clusters(rows, k, rounds, components):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and np.isfinite(x) and abs(x) < 2**19 for x in v)]
    named = sorted(((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))[:k]
    centroids = [v for _, v in named]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds if centroids else 0):
        groups = defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept if centroids), key=repr), centroids


def test_clusters_are_those_of_all_pairs(spark):
    rng = np.random.default_rng(1)
    means = rng.normal(0, 1, (6, 4))
    rows = [(i, (means[i % 6] + rng.normal(0, 0.2, 4)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(400)]  # a very common vector
    rows += [(5, rows[5][1]), (None, rows[6][1]), (None, None), (2001, None), (2002, []), (2003, [1.0, None, 0.0, 0.0]), (2004, [1.0, float("nan"), 0.0, 0.0]),
             (2005, [float("inf"), 0.0, 0.0, 0.0]), (2006, [1.0] * 5), (2007, [3e38, 0.0, 0.0, 0.0]), (2008, [-400_000.0, 9.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance int").repartition(3)
    got, centroids = clustering.cluster(df, k=9, rounds=4, components=4)
    want, means_wanted = brute_clusters(rows, 9, 4, 4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert centroids.tolist() == means_wanted


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    got, centroids = clustering.cluster(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.25, 1.0])], schema), k=5, components=2)
    assert sorted(r["distance"] for r in got.collect()) == [0, 0] and len(centroids) == 2
    for rows in ([], [(1, [float("nan"), 0.0])], [(None, [1.0, 1.0])]):
        got, centroids = clustering.cluster(spark.createDataFrame(rows, schema), k=5, components=2)
        assert got.collect() == [] and len(centroids) == 0


def test_boxes_spare_comparisons(spark):
    rng = np.random.default_rng(4)
    means = rng.normal(0, 1, (20, 16))
    rows = [(i, (means[i % 20] + rng.normal(0, 0.1, 16)).tolist()) for i in range(4000)]
    vectors = clustering.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=16)
    blocks = clustering.blocks_in_order(vectors, 16, block=32)
    _, share = clustering._round(blocks, np.floor(means * 256).astype(np.int64))
    assert share < 0.5


# ---- alignment


def brute_alignment(texts):
    """Per text what align returns, from the libraries' own tokens and plain loops."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    bpe = ByteBpe(A, True)
    linked, rows = [], []
    for t in texts:
        whole = (" " + (t or "")).encode()
        ia, ib = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        ta = [bpe.bytes_of[i] for i in ia]
        tb = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if not t or b"".join(ta) != whole or b"".join(tb) != whole:
            linked.append(Counter())
            rows.append((0, 0, 0, ""))
            continue
        ends_a, ends_b = list(itertools.accumulate(map(len, ta))), list(itertools.accumulate(map(len, tb)))
        common = sorted(set(ends_a) & set(ends_b))
        groups, x, y = [], 0, 0
        for end in common:
            u, v = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
            groups.append(",".join(map(str, ia[x:u])) + "|" + ",".join(map(str, ib[y:v])))
            x, y = u, v
        pairs = Counter()
        j = 0
        for i, e in enumerate(ends_a):
            while ends_b[j] <= e - len(ta[i]):
                j += 1
            k = j
            while k < len(ib) and ends_b[k] - len(tb[k]) < e:
                pairs[ia[i], ib[k]] += 1
                k += 1
        linked.append(pairs)
        rows.append((len(ia), len(ib), len(common), ";".join(groups)))
    count = Counter(p for pairs in linked for p in pairs)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    links = Counter()
    for pairs in linked:
        links.update(pairs)
    return [(n_a, n_b, n_g, sum(p.values()), sum(m for q, m in p.items() if count[q] == best[q[0]]), sum(m * count[q] for q, m in p.items()), g)
            for (n_a, n_b, n_g, g), p in zip(rows, linked, strict=True)], count, links


FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("chunk,postings", [(8192, 2_000_000), (16, 2_000_000), (8192, 300)])
def test_alignment_of_all_documents(spark, chunk, postings):
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS + ODD + ["the same words again " * 40] * 60)]
    rows += [(1000 + r["doc_id"], r["text"]) for r in table(spark, SF, "documents").filter("doc_id < 60").collect()]
    docs, pairs = alignment.align(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), A, B, chunk=chunk, most=postings)
    want, count, links = brute_alignment([t for _, t in rows])
    got = {r["doc_id"]: r for r in docs.collect()}
    assert len(got) == len(rows)
    for (k, _), w in zip(rows, want, strict=True):
        assert tuple(got[k][f] for f in FIELDS) == w
        assert got[k]["groups_sha256"] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[0] else "")
    found = pairs.collect()
    assert {(r["a"], r["b"]): r["n"] for r in found} == count
    assert {(r["a"], r["b"]): r["links"] for r in found} == links


def test_bitmaps_in_both_forms_round_trip():
    rng = np.random.default_rng(2)
    runs = [np.sort(rng.choice(alignment.CHUNK, n, replace=False)) for n in (1, 3, 511, 512, 513, 8192, 2)]
    starts = np.cumsum([0, *map(len, runs)])[:-1]
    bitmaps = alignment.compressed(np.concatenate(runs), starts)
    assert max(len(x.as_py()) for x in bitmaps) == alignment.CHUNK // 8
    for part in (bitmaps, bitmaps.slice(2, 4)):
        places, source = alignment.decoded(part)
        first = 0 if part is bitmaps else 2
        for i in range(len(part)):
            assert sorted(places[source == i].tolist()) == runs[first + i].tolist()


def test_alignment_of_odd_rows(spark):
    docs = documents(spark, EDGE_TEXTS + ODD)
    got = alignment.align(docs, A, B)[0].collect()
    want = Counter((r["doc_id"], *w) for r, w in zip(docs.collect(), brute_alignment([r["text"] for r in docs.collect()])[0], strict=True))
    assert Counter((r["doc_id"], *(r[f] for f in FIELDS)) for r in got) == want
    empty = alignment.align(docs.limit(0), A, B)
    assert empty[0].collect() == [] and empty[1].collect() == []


def test_alignment_as_registered(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op13_alignment"](spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    want, _, _ = brute_alignment([d["text"] for d in docs])
    for d, w in zip(docs, want, strict=True):
        assert tuple(rows[d["doc_id"]][f] for f in FIELDS[:-1]) == w[:-1]
        assert rows[d["doc_id"]]["groups_sha256"] == (hashlib.sha256(w[-1].encode()).hexdigest() if w[0] else "")
