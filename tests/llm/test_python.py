"""Operators 2, 3, 6, 8, 9, 10 and the pipeline against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from clearspan.llm import extraction, jaccard, keyed, mixing, packing, spans, tokens, toxicity
from clearspan.llm.common import shared_path
from clearspan.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def held(doc_id, folds):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_spans_and_pieces(rows):
    texts = [r[1] for r in rows]
    batch = pa.record_batch({"text": pa.array(texts)})
    seen = []
    for part, data, offsets in spans.blocks(iter([batch]), size=300):
        starts, ends, before = spans.words_of(data, offsets)
        raw = data.tobytes()
        for k in range(part.num_rows):
            seen.append([raw[a:b].decode() for a, b in zip(starts[before[k] : before[k + 1]], ends[before[k] : before[k + 1]], strict=True)])
    assert seen == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        plain, own = Tokenizer.from_file(path), tokens.Pieces(path)
        for _ in range(2):
            got = []
            for part, data, offsets in spans.blocks(iter([batch])):
                ids, before = own.encode(data, offsets)
                got += [ids[before[k] : before[k + 1]].tolist() for k in range(part.num_rows)]
            assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def links_of(texts, n, num, den):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and den * o >= num * (len(sets[i]) + len(sets[j]) - o):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 8, 10)])
def test_components_of_near_copies(spark, small, rows, n, num, den):
    """Chains of edits around the threshold, copies and short texts."""
    rng = np.random.default_rng(n)
    data = []
    for family in range(8):
        text = [f"f{family}x{k}" for k in range(int(rng.integers(2, 120)))]
        for _ in range(9):
            text = list(text)
            for _ in range(int(rng.integers(0, 1 + len(text) // 20))):
                text[int(rng.integers(len(text)))] = f"y{int(rng.integers(1000))}"
            data.append((len(data) * 3 % 331 + 1000 * len(data), " ".join(text)))
    data += [(10**9 + k, t) for k, (_, t, *_) in enumerate(rows)]
    table = spark.createDataFrame(data, "doc_id long, text string")
    sizes, roots = links_of([t for _, t in data], n, num, den)
    least = {}
    for (doc_id, _), r in zip(data, roots, strict=True):
        least[r] = min(least.get(r, doc_id), doc_id)
    got = {r.doc_id: (r.n, r.component_id) for r in jaccard.similar(table, n, num, den).collect()}
    assert got == {d: (s, least[r]) for (d, _), s, r in zip(data, sizes, roots, strict=True)}


def test_small_groups_are_opened(spark, monkeypatch):
    """With groups of three, links between groups carry the components."""
    monkeypatch.setattr(jaccard, "GROUP", 3)
    base = [f"w{k}" for k in range(100)]
    data = []
    for k in range(30):
        text = list(base)
        text[k], text[(k * 7 + 1) % 100] = "x", "z"
        data.append((k, " ".join(text)))
    table = spark.createDataFrame(data, "doc_id long, text string")
    _, roots = links_of([t for _, t in data], 3, 9, 10)
    got = {r.doc_id: r.component_id for r in jaccard.similar(table, 3, 9, 10).collect()}
    assert got == dict(enumerate(roots))


def test_one_of_each_keeps_rows_without_words(docs, no_docs, rows):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    found = Counter(r.doc_id for r in kept.collect())
    assert found[1] == 1 and not found[2] and not found[3] and found[4] == found[5] == found[6] == 1 and found[13] == 1 and found[None] == 2
    assert jaccard.one_of_each(no_docs).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def test_toxicity_on_held_out_rows(spark, docs, no_docs):
    folder = "/root/testdata/sf0.01"
    big = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = {r.doc_id: r.score for r in toxicity.scored(big, toxicity.fit(big, labels)).collect()}
    assert len(got) == big.count() and all(0 <= s <= 1 for s in got.values())
    toxic = [(got[r.doc_id], r.toxic) for r in labels.collect() if held(r.doc_id, 5)]
    assert np.mean([(s >= 0.5) == t for s, t in toxic]) > 0.9
    none = toxicity.fit(no_docs, labels.limit(0))
    assert toxicity.scored(docs, none).count() == docs.count()
    odd = labels.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (3, None), (1, 1)], "doc_id long, toxic int"))
    assert toxicity.scored(docs, toxicity.fit(docs, odd)).filter("score IS NULL").count() == 0


def test_toxicity_ignores_held_out_labels(spark):
    texts = [(k, f"filler{k % 5} words here " + ("badword again" if k % 3 == 0 else "nice day")) for k in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    right = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in texts], "doc_id long, toxic int")
    wrong = spark.createDataFrame([(k, int(k % 3 == 0) ^ int(held(k, 5))) for k, _ in texts], "doc_id long, toxic int")
    scores = [{r.doc_id: r.score for r in toxicity.scored(docs, toxicity.fit(docs, x)).collect()} for x in (right, wrong)]
    assert scores[0] == scores[1]
    assert all((scores[0][k] >= 0.5) == (k % 3 == 0) for k, _ in texts)


def test_mixing_scores(spark, small, docs, no_docs):
    data = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    counts, ends = Counter(), 0
    for i, t in data:
        if not held(i, 10):
            counts.update(words(t))
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    got = {r.doc_id: r for r in mixing.scored(small.select("doc_id", "text")).collect()}
    for i, t in data:
        w, r = words(t), got[i]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in [*(counts[x] for x in w), ends])
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w) + 1, sum(counts[x] > 0 for x in w) + 1, total, held(i, 10))
        assert r.base_score == pytest.approx(base) and r.score < 0
    odd = mixing.scored(docs).collect()
    assert len(odd) == docs.count() and all(r.score < 0 and r.n_tokens >= 1 for r in odd)
    assert mixing.scored(no_docs).count() == 0


def encoded(rows, name, end):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return [(r[0], [*plain.encode(r[1] or "", add_special_tokens=False).ids, end]) for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_round_trip(docs, rows, no_docs):
    got = packing.packed(packing.token_pieces(docs), group=16).drop("salt").collect()
    want = Counter()
    for doc_id, ids in encoded(rows, packing.TOKENIZER, 0):
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[(doc_id, piece, start, len(part), crc(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed(packing.token_pieces(no_docs)).count() == 0


def test_sum_of_squares_is_tight():
    rng = np.random.default_rng(3)
    lengths = np.sort(np.minimum(2048, rng.lognormal(6, 0.8, 4000).astype(int) + 1))[::-1]
    sequence, offset = packing.sum_of_squares(lengths)
    assert sequence.max() + 1 <= 1.01 * math.ceil(lengths.sum() / 2048)
    assert (offset + lengths <= 2048).all()


def test_token_files_round_trip(spark, docs, rows, no_docs):
    path = shared_path(spark, "test-files")
    keyed.write_shards(docs, path, shard_ids=500)
    got = keyed.read_shards(spark, path).collect()
    texts = encoded(rows, keyed.TOKENIZER, 2)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(i), crc(i)) for d, i in texts)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda d: (d is not None, d or 0))
    found = Counter((r.doc_id, tuple(r.ids)) for r in keyed.fetch(spark, path, [1, 12, 13, 999, -5]).collect())
    assert found == Counter((d, tuple(i)) for d, i in texts if d in (1, 12, 13))
    assert keyed.fetch(spark, path, []).count() == 0
    empty = shared_path(spark, "test-files")
    keyed.write_shards(no_docs, empty)
    assert keyed.read_shards(spark, empty).count() == 0


def test_perfect_hash_is_minimal():
    keys = spans.mix(np.arange(5000, dtype=np.uint64))
    function = keyed.PerfectHash.build(keys)
    assert sorted(function.slots(keys).tolist()) == list(range(5000))


PAGE = """<!DOCTYPE html><html class="no-js has-sidebar"><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1><a href="/">Home</a></header><nav><ul><li><a>a</a><li><a>b</a></ul></nav>
<div id="main"><div class="post"><h2>Title &amp; more</h2><p>First <b>para</b> with <a href=q>a link</a>\n and text.<p>Second &eacute;.
<script>var x = "</p><p>no</p>";</script><div class="ad">Buy now</div><p>Of.</p></div><aside>Related</aside>
<section id="comments"><p>I am a long comment of a reader, and I should not be part of the text at all.</p></section></div>
<div class="cookie-notice">We use cookies</div><form><label>Name</label><input></form><!-- x --><footer>&copy; Site"""


def test_main_text(spark):
    assert extraction.main_text(PAGE) == "Title & more\nFirst para with a link and text.\nSecond é.\nOf."
    for odd in (None, "", "   ", "<", "<p", "</p></div>", "<!-- never ends", "<script>no end", "&#x110000; &bogus;"):
        assert isinstance(extraction.main_text(odd), str)
    pages = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 6), (None, "v", "", None), (1, "u", PAGE, 5)], "page_id long, url string, html string, n_chars int")
    got = extraction.extracted(pages).collect()
    assert len(got) == 4 and got[0].text == got[3].text and [r.n_chars for r in got] == [len(r.text) for r in got]
    assert extraction.extracted(pages.limit(0)).count() == 0


def test_articles_of_pages(spark):
    from html import unescape

    for r in extraction.op10_main_text(spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x)))).strip() for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(x for x in parts if x)


def cut_size(flow_edges, n, side):
    return sum(w for a, b, w in flow_edges if side[a] and not side[b])


def test_minimum_cut_against_all_cuts():
    rng = np.random.default_rng(5)
    for _ in range(30):
        n = 6
        edges = [(int(a), int(b), float(rng.integers(1, 9))) for a, b in rng.integers(0, n + 2, (14, 2)) if a != b]
        flow = extraction.Flow(n + 2)
        for a, b, w in edges:
            flow.join(a, b, w)
        best = min(
            cut_size(edges, n, [bool(mask >> k & 1) for k in range(n)] + [True, False]) for mask in range(1 << n)
        )
        assert cut_size(edges, n, flow.source_side(n, n + 1)) == pytest.approx(best)


def test_pipeline_stages(spark, small):
    docs, kept = small, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER).cache()
        if k < 4:
            assert out.columns == small.columns
            kept.append(out.count())
            docs = out
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    assert kept[0] >= kept[1] >= kept[2] > 0 and ids
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == ids
    assert corpus_pipeline.ORACLE_SQL is None
