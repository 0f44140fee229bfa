"""Near-duplicates, decontamination, archives, pages, conversations and the pipeline."""

import collections
import hashlib
import random
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from helpers import EDGE_TEXTS, SF, components, documents  # noqa: E402

from perigee.llm import chat, decontaminate, extract, neardup, warc  # noqa: E402
from perigee.llm.dom import Page  # noqa: E402
from perigee.llm.template import TemplateError, compile_template, fold_body, parse  # noqa: E402
from perigee.session import fresh_path  # noqa: E402


def family(r, copies, words=120):
    """A text and near copies of it with more and more words changed."""
    base = [f"w{r.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for i in range(copies):
        text = list(base)
        for _ in range(i % 9):
            text[r.randrange(words)] = f"x{r.randint(0, 10**6)}"
        out.append(" ".join(text))
    return out


# ---- near-duplicates


def test_components_are_those_of_all_pairs(spark):
    r = random.Random(1)
    texts = [t for _ in range(6) for t in family(r, r.choice([2, 5, 40]), r.choice([12, 60, 900]))]
    texts += ["A b\tC", "a B c", "", None, "a b c d e", "A B C D E", "a b c d"] + texts[:10]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = components(rows)
    assert len(got) == len(rows)
    for g in got:
        assert (g["n_shingles"], g["component_id"]) == want[g["doc_id"]]
        assert g["kept"] == (g["doc_id"] == g["component_id"])


def test_blocks_find_links_that_stars_miss(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    r = random.Random(2)
    rows = list(enumerate(family(r, 60, 40)))
    r.shuffle(rows)
    got = {g["doc_id"]: g["component_id"] for g in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for d, (_, c) in components(rows).items()}


def test_near_duplicates_of_odd_rows(spark):
    docs = documents(spark, EDGE_TEXTS)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    last = max(g["doc_id"] for g in got if g["doc_id"] is not None)
    same = [g for g in got if g["component_id"] == last - 1]
    assert sorted((g["doc_id"] is None, g["kept"]) for g in same) == [(False, False), (False, False), (False, True), (True, False)]
    assert neardup.keep_one(docs).columns == docs.columns
    assert neardup.near_duplicates(docs.limit(0)).collect() == []
    nameless = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f")], "doc_id long, text string")
    assert [(g["component_id"], g["kept"]) for g in neardup.near_duplicates(nameless).collect()] == [(None, True)] * 2


def test_contract_chains(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 300), (300, 100), (500, 500)]
    got = {r["node"]: r["root"] for r in neardup.contract(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}


# ---- decontamination


def brute_matches(docs, items):
    def shingles(t):
        w = re.findall(r"\w+", (t or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    out = {}
    for i, t in items:
        own = collections.Counter(shingles(t))
        size = sum(own.values())
        for d, text in docs:
            s = shingles(text)
            n = min(size, len(s))
            if not size or not set(own) & set(s):
                continue
            for a in range(len(s) - n + 1):
                both = sum((collections.Counter(s[a : a + n]) & own).values())
                if both / (n + size - both) >= 0.75:
                    out[d, i] = max(out.get((d, i), 0), both / (n + size - both))
    return out


def test_decontamination_against_all_windows(spark, monkeypatch):
    r = random.Random(5)
    items = [(i, " ".join(f"q{r.randint(0, 5000)}" for _ in range(r.choice([4, 8, 20, 33])))) for i in range(30)] + [(30, None), (31, ""), (32, "one two")]
    docs = []
    for k in range(240):
        words = r.choice(items[:30])[1].split()
        for _ in range(r.randint(0, 4)):
            at = r.randrange(len(words))
            words[at : at + r.randint(0, 1)] = ["z%d" % k]
        pad = [f"p{r.randint(0, 5000)}" for _ in range(r.randint(0, 60))]
        at = r.randint(0, len(pad))
        docs.append((k, " ".join(pad[:at]) + "\n" + "*** ".join(words).upper() + "!! " + " ".join(pad[at:])))
    docs += [(1000, None), (1001, ""), (1002, "one two")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute_matches(docs, items)
    for at_once in (5000, 7):
        monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", at_once)
        got = {(g["doc_id"], g["item_id"]): g["similarity"] for g in decontaminate.contaminated(frame, benchmark).collect()}
        assert got == pytest.approx(want)
        clean = decontaminate.drop_contaminated(frame, benchmark)
        assert {c["doc_id"] for c in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    assert len(want) > 40


def test_decontamination_of_odd_rows(spark):
    docs = documents(spark, [*EDGE_TEXTS, "the first of all items is here"])
    benchmark = spark.createDataFrame([(1, "the first of all items is here"), (1, "the first of all items is here"), (None, "x")], "item_id long, text string")
    assert [tuple(g)[:3] for g in decontaminate.contaminated(docs, benchmark).collect()] == [(-991, 1, 1.0)] * 2 + [(None, 1, 1.0)]
    assert decontaminate.contaminated(docs, benchmark.limit(0)).collect() == []
    assert decontaminate.contaminated(docs.limit(0), benchmark).collect() == []
    assert decontaminate.drop_contaminated(docs, benchmark).columns == docs.columns


# ---- archives

INNER = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"


def archive_rows():
    r = random.Random(2)
    rows = [(i, "http://x/WARC/1.1\r\n", "x" * r.randint(0, 3000) + INNER * r.randint(0, 4) + "WARC/1.1\r\n" + "é" * r.randint(0, 900) + INNER[: r.randint(0, 120)]) for i in range(40)]
    rows += [(100 + i, f"u{i}", f"<p>{i}</p>" * r.randint(0, 400)) for i in range(60)]
    rows += [(200, None, INNER * 3000), (201, "u", None), (None, "u", "n" * 2000), (202, "u", "d" * 5000), (203, "u", "d" * 5000), (203, "u", "d" * 5000),
             (None, "u", "d" * 5000), (205, "u", "s" * 999), (206, "u", "s" * 999)]
    return rows


def wanted_records(rows):
    ids = collections.defaultdict(list)
    for p, _, h in rows:
        if len((h or "").encode()) >= 1000:
            ids[h].append(p)
    out = collections.Counter()
    for p, _, h in rows:
        owner = max((x for x in ids.get(h, []) if x is not None), default=None)
        revisit = owner is not None and len(ids[h]) > 1 and p != owner
        data = (h or "").encode()
        out[p, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", owner if revisit else None] += 1
    return out


@pytest.mark.parametrize("block", ["64m", "50k"])
def test_archives(spark, block):
    rows = archive_rows()
    path = fresh_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        found = warc.read_records(spark, path, payload=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    number = lambda s: int(s[9:]) if s and s[9:] else None
    got = collections.Counter((number(f["id"]), f["payload_bytes"], f["payload_digest"], f["type"], number(f["refers_to"])) for f in found)
    assert got == wanted_records(rows)
    assert all(hashlib.sha1(f["payload"]).hexdigest() == f["payload_digest"] for f in found if f["type"] == "response")


def test_empty_and_damaged_archives(spark, tmp_path):
    path = fresh_path(spark, "warc-empty")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_records(spark, path).collect() == []
    (tmp_path / "cut.warc").write_bytes(INNER.encode()[:-20])
    with pytest.raises(ValueError, match="damaged"):
        warc.read_records(spark, str(tmp_path))


# ---- pages


@pytest.fixture(scope="module")
def trees(spark):
    return extract.fit(spark)


def test_held_out_layouts(trees):
    right = total = 0
    for seed in range(50_000, 50_150):
        page = Page(extract.labelled_page(seed))
        scored, x = extract.page_features(page)
        kept = extract.decoded(page, scored, extract.margins(trees, x))
        texts = {e for e, _, t in page.texts if t.strip()}
        for i in scored:
            if i in texts:
                total += 1
                right += kept[i] == (page.named(i).get("k") == "1")
    assert right >= 0.98 * total


def test_article_is_extracted_whole(spark, trees):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {g["page_id"]: g for g in extract.extract(pages, trees).collect()}
    for p in pages.collect():
        inner = p["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[p["page_id"]]["text"], got[p["page_id"]]["n_chars"]) == (want, len(want))


def test_decoding_never_contradicts(trees):
    for seed in range(60_000, 60_030):
        page = Page(extract.labelled_page(seed))
        scored, x = extract.page_features(page)
        r = random.Random(seed)
        kept = extract.decoded(page, scored, [r.uniform(-1, 1) for _ in scored])
        for i in scored:
            up = page.parent[i]
            while kept[i] and up > 0:
                assert kept[up] or up not in scored
                up = page.parent[up]


def test_odd_pages(spark, trees):
    sources = [None, "", "plain", "<", "<p>one<p>two &amp; three", "<" * 3000, "<p>" * 3000 + "deep", "<script>x", "<!-- open", "<a href='x>y", "</p></div>z<br>q"]
    rows = [(i, "u", s, "x") for i, s in enumerate(sources)] + [(None, None, "<p>two</p>", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {g["page_id"]: g["text"] for g in extract.extract(frame, trees).collect()}
    assert got[0] == got[1] == got[7] == "" and got[4] == "one\n\ntwo & three" and got[None] == "two"
    assert extract.extract(frame.limit(0), trees).collect() == []


def test_text_outside_blocks(spark, trees):
    """An article that stands directly in body or in inline elements, and a page without tags, give their text."""
    one = "The river rose above the lower bridge during the night, and by morning the old market was under water."
    two = "Nobody was hurt, the mayor said, but the repair of the houses will take until late in the summer."
    both = f"{one}<br><br>{two}"
    sources = ["plain", both, f"<html><body>{both}</body></html>", f"<body><b>{both}</b></body>", f"<body><font>{both}</font>", f"<my-story>{both}</my-story>",
               f"<body><h1>Flood</h1>{one}<p>{two}</p>{one}</body>"]
    want = ["plain", *[f"{one} {two}"] * 5, f"Flood\n\n{one}\n\n{two}\n\n{one}"]
    assert extract.extract_texts(sources, trees) == want
    nav = "".join(f'<li><a href="/{i}">Page {i}</a></li>' for i in range(6))
    page = f'<html><body><nav><ul>{nav}</ul></nav>{both}<hr><a href="/a">About</a> | <a href="/b">Contact</a> | <a href="/c">Jobs</a></body></html>'
    assert extract.extract_texts([page], trees) == [f"{one} {two}"]
    odd = ["</p></div>z<br>q", "<p>one<p>two &amp; three", "<script>x"]
    assert extract.extract_texts(odd, trees) == ["z q", "one\n\ntwo & three", ""]


# ---- conversations


def test_conversations_read_back(spark):
    hard = "\\### Assistant: </turn> ok"
    rows = [(1, None, None, None), (None, 0, "a: b\\", "x</turn>\n### user: y\\"), (2, 0, "assistant", "</turn>\n" * 3 + "\\"), (2, 0, "assistant", "</turn>\n" * 3 + "\\"),
            (3, 1, "", ""), (4, 0, "assistant", ""), (-7, 0, "user", hard), (-7, 1, "assistant", hard), (9, 1, "assistant", "\U0001f916" * 9000), (9, 0, "system", "s")]
    rows += [(5, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(3000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part long")
    got = {g["conv_id"]: g for g in chat.read_back(chat.format_conversations(frame)).collect()}
    turns = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] if r[1] is not None else -1)):
        turns[c].append((role or "", text or ""))
    assert set(got) == set(turns)
    for c, all_turns in turns.items():
        trained = "".join(t for r, t in all_turns if r == "assistant")
        assert got[c]["n_turns"] == len(all_turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in all_turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(trained), hashlib.sha256(trained.encode()).hexdigest())
    parts = chat.format_conversations(frame).filter("conv_id = -7").orderBy("part").collect()
    assert "".join(p["text"] for p in parts).count("\n### ") == 1 and got[-7]["formatted_chars"] == sum(len(p["text"]) for p in parts)
    assert chat.read_back(chat.format_conversations(frame.limit(0))).collect() == []


def test_templates():
    assert fold_body(parse("{% if 'a' ~ 1 == 'a1' %}x{{ 'b' | upper }}{% else %}no{% endif %}y")) == [("text", "xBy")]
    run = compile_template("{% for m in messages %}{% if loop.first and not loop.last %}<{% elif m.role == 'u' or false %}u{% else %}{{ m.text | trim }}"
                           "{% endif %}{% generation %}{{ loop.index0 }}{% endgeneration %}{% endfor %}!")
    assert list(run([{"role": "u", "text": ""}, {"role": "u", "text": ""}, {"role": "a", "text": " z "}])) == [
        ("<", False), ("0", True), ("u", False), ("1", True), ("z", False), ("2", True), ("!", False)]
    for wrong in ("{% for m in others %}{% endfor %}", "{{ m.text | eval }}", "{{ m.text.upper }}", "{{ open('x') }}", "{% if true %}", "{% include 'x' %}", "{{ 1 + 1 }}"):
        with pytest.raises(TemplateError):
            parse(wrong)
    with pytest.raises(TemplateError):
        list(compile_template("{% for m in messages %}{{ m.secret }}{% endfor %}")([{"role": "", "text": ""}]))


# ---- pipeline


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    from helpers import quality_counts, secret_spans

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept, sf = {}, "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, f"test-{name}")
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        ids = {r["doc_id"] for r in after.collect()}
        kept[name] = (before, ids, after)
        docs = after
    before, ids, _ = kept["quality_rules"]
    failing = {d for d, t in before if (c := quality_counts(t)) and (c[0] < 50 or 100 * c[4] > 50 * c[0])}
    assert not failing & ids and len(ids) > 100
    before, ids, _ = kept["near_duplicates"]
    assert ids == {d for d, (_, low) in components(before).items() if d == low}
    before, ids, _ = kept["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert ids == {d for d, _ in before} - {d for d, _ in brute_matches(before, items)}
    before, ids, after = kept["secret_scans"]
    assert ids == {d for d, _ in before} and not any(secret_spans(r["text"]) for r in after.collect())
    before, ids, after = kept["bpe_encode_decode"]
    from tokenizers import Tokenizer

    from perigee.llm.bpe import WORD_BPE
    library = Tokenizer.from_file(WORD_BPE)
    assert {r["doc_id"]: r["n_tokens"] for r in after.collect()} == {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in before}


def test_registered_queries_read_whole_tables(spark):
    """Each registered query returns a row per row of its table."""
    import __spark_entry__ as entry

    queries = entry.queries()
    n = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("documents", "pages")}
    for name, rows in {"op1_warc": n["pages"], "op3_bpe": n["documents"], "op9_token_counts": n["documents"], "op8_chat": None}.items():
        got = queries[name](spark, SF).count()
        assert rows is None or got == rows
    assert len([q for q in queries if re.match(r"op\d+_", q)]) == 10 and "pipeline" in queries


def test_formulas_and_raw_elements_without_an_end():
    from perigee.llm.dom import Page, joined

    def words(source):
        return joined(Page(source), [True] * 99).split()

    assert words("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["so", "x=2", "holds"]
    assert words("<p>a <svg><path d='M0'> b</p><p>c") == ["a", "b", "c"]
    assert words("<p>a<noscript>hidden</noscript> b") == ["a", "b"] and words("<p>a <noscript>b<p>c") == ["a", "b", "c"]
    assert words("<p>a<script>if (x) {}") == ["a"]


@pytest.mark.parametrize("source", ["<div>{}</span>", "<i>{}<hr>", "<thead>{}<hr>", "<template>{}", "<p><table><i>{}<hr>"])
def test_parse_time_grows_with_the_page(source):
    import time

    from perigee.llm.dom import Page

    first, rest = source.split("{}")
    took = []
    for n in (20_000, 80_000):
        start = time.perf_counter()
        Page(first * n + rest * n)
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0] + 0.2


def test_simhash_of_numbered_shingles():
    """Sliding sums against each window's own, with few different shingles; one window's order doesn't matter."""
    import numpy as np

    rng = np.random.default_rng(2)
    for size in (1, 3, 20):
        s = rng.integers(1, 1 << 60, 6).astype(np.uint64)[rng.integers(0, 6, 200)]
        starts = np.arange(5, 150)
        got = decontaminate._simhash(s, starts, size)
        assert got.tolist() == [int(decontaminate._simhash(rng.permutation(s[a : a + size]), np.array([0]), size)[0]) for a in starts]


def test_passages_followed_by_repeated_words_are_found():
    """Windows exactly at the least similarity whose other shingles repeat one word, and items that repeat themselves."""
    rng, missed = random.Random(4), 0
    for trial in range(300):
        item = [f"w{rng.randrange(10**6)}" for _ in range(144)]
        if trial % 3 == 0:
            item = item[:100] + ["again"] * 20 + item[120:]
        text = [f"p{i}" for i in range(30)] + item[:124] + ["filler"] * 60
        index = decontaminate.BenchmarkIndex([(1, " ".join(item))])
        want = brute_matches([(0, " ".join(text))], [(1, " ".join(item))])
        got = index.matches(" ".join(text))
        missed += not got
        assert not got or got[0][0] == pytest.approx(want[0, 1])
    assert missed <= 3
