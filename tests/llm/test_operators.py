"""Every operator against a plain version of what it computes."""

import collections
import hashlib
import os
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelattice.llm import grammar, language, link_trust, quality_crf, warc_fixity
from pricelattice.llm import words as W
from pricelattice.llm.decontaminate import find_contamination
from pricelattice.llm.fm_index import FMIndex
from pricelattice.llm.near_dedup import band_keys, near_duplicates, sketch
from pricelattice.llm.packing import cutting_stock, default_tokenizer, encode, pack
from pricelattice.llm.passage_dedup import covering, remove_repeats, repeated_passages, tune_bands
from pricelattice.llm.sets import common, spanning
from pricelattice.llm.sharding import assign_shards, jump_hash
from pricelattice.llm.steps import components, numbered
from pricelattice.llm.topk import exact_top_k

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n))


ODD = [
    (None, None), (1, None), (2, ""), (3, " \n\t "), (4, prose(1, 80)), (5, prose(1, 80)), (5, prose(1, 80)),
    (6, prose(1, 80).upper()), (7, prose(2, 30_000)), (None, prose(1, 80)), (8, "one two"), (9, "ONE  two"), (10, "x" * 50_000),
    (11, prose(3, 40) + " " + prose(4, 60) + " " + prose(5, 40)), (12, prose(6, 33) + " " + prose(4, 60) + "\n" + prose(7, 21)),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated ids, ties, and columns that clash with results."""
    rows = [(i, t, "en", None, None, "mine", "yours") for i, t in ODD]
    return spark.createDataFrame(rows, DOCS + ", kept string, spans string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# ---- words ---------------------------------------------------------------------------


def test_words_match_a_plain_split():
    texts = ["Héllo  World\x0bfoo\x1cbar", None, "", "a" * 9000 + " b", "x-1 ÀB\x7f_c"]
    for kind, pattern in ((W.NON_SPACE, rb"[^\x20\x09-\x0D]+"), (W.ALPHANUMERIC, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = W.words_of(texts, kind)
        for i, text in enumerate(texts):
            own = [words.data[a:b].lower() for a, b in zip(words.starts, words.ends)][words.first[i] : words.first[i + 1]]
            assert own == re.findall(pattern, (text or "").encode().lower())
    assert len(np.unique(W.words_of(["a A b ab"]).hashes)) == 3


def test_long_words_with_blocks_exchanged_differ():
    a, b = "a" * W.RUN, "b" * W.RUN
    words = [a + b, b + a, a + b + "c", a + "c" + b, (a + b) * 1200, (b + a) * 1200, (a + b) * 1199 + b + a, "x" * 5_000, "x" * 5_001]
    assert len(np.unique(W.words_of([" ".join(words)]).hashes)) == len(words)
    assert (W.words_of([w.upper() for w in words]).hashes == W.words_of([" ".join(words)]).hashes).all()


def test_long_words_are_no_copies(spark):
    a, b = "a" * W.RUN, "b" * W.RUN
    docs = spark.createDataFrame([(1, a + b), (2, b + a), (3, a + b)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()} == {(1, 1), (2, 2), (3, 1)}
    found = find_contamination(docs, spark.createDataFrame([(7, a + b)], "item_id long, text string"))
    assert {(r.doc_id, r.contaminated) for r in found.collect()} == {(1, True), (2, False), (3, True)}


# ---- 1 packing -------------------------------------------------------------------------


def test_encode_is_the_tokenizer():
    from tokenizers import Tokenizer

    texts = [
        "It's we'll I'M 'tis ''s' 12ab3 x²y ½ ß İstanbul Σας <|endoftext|>x <| a\x1cb", "e\u0301 é ǅ Ⱥb \xa0n \u200bzw ＡＢ 漢字 !!..#a_b",
        "a×b÷c", "", None, "¡hola! 10€ 5°",
    ]
    found = Tokenizer.from_file(default_tokenizer()).encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert encode(texts, default_tokenizer()) == [np.array(e.ids, "<u4").tobytes() for e in found]


def random_texts(seed, n):
    rng = np.random.default_rng(seed)
    kinds = ["ab 'stremvld", "aA1 '!\n\t  ", "é²½ßİΣς漢́ 's <|endoftext|>\u200b\xa0\x1c\x85　Ⱥ١", "\U0010ffff a𝔄😀 \r\n"]
    kinds = [list(k) for k in [*kinds, "".join(kinds), "".join(map(chr, range(0x20, 0x300)))]]
    return ["".join(rng.choice(kinds[i % len(kinds)], rng.integers(0, 30))) for i in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "no_normaliser", "other_rule"])
def test_encoder_is_the_tokenizer_on_random_texts(tmp_path, name, monkeypatch):
    """Also files with other rules, which the fast way does not know, long texts in parts, and a cache that overflows."""
    import json

    import public_tokenizers
    from pricelattice.llm import token_ids
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name if name.endswith("json") else "word_bpe_49k.json")
    if not name.endswith("json"):
        with open(path) as file:
            rules = json.load(file)
        if name == "no_normaliser":
            rules["normalizer"] = None
        else:
            rules["pre_tokenizer"]["pretokenizers"][0]["pattern"] = {"Regex": "[a-z]|[0-9]+"}
        path = str(tmp_path / "other.json")
        with open(path, "w") as file:
            json.dump(rules, file)
    monkeypatch.setattr(token_ids, "PART", 40)
    monkeypatch.setattr(token_ids, "CACHE_WORDS", 500)
    texts = [*random_texts(5, 4000), "Hello World ABC", None, "It's a long text, isn't it?  \n " * 30]
    ids, first = token_ids.Encoder(path).encode(texts, 7) if name.endswith("json") else token_ids.encoder(path).encode(texts, 7)
    want = [e.ids + [7] for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == want


def test_byte_level_words_go_to_the_model_once(monkeypatch):
    """No search through all words kept for each slice, and no second cutting of words; words of one hash stay apart."""
    import types

    import public_tokenizers
    from pricelattice.llm import token_ids

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*random_texts(7, 400), *random_texts(8, 400), *random_texts(7, 400), None]
    for hashed in (hash, lambda word: len(word) % 3):
        monkeypatch.setattr(token_ids, "hash", hashed, raising=False)
        encoder = token_ids.Encoder(path)
        own, asked = encoder.tokenizer, []
        encoder.tokenizer = types.SimpleNamespace(  # without encode_batch
            encode=own.encode, encode_batch_fast=own.encode_batch_fast, normalizer=own.normalizer, pre_tokenizer=own.pre_tokenizer)
        encoder.model = types.SimpleNamespace(tokenize=lambda word, model=own.model: (asked.append(word), model.tokenize(word))[1])
        for at in range(0, len(texts), 100):
            ids, first = encoder.encode(texts[at : at + 100], 7)
            want = [own.encode(t or "", add_special_tokens=False).ids + [7] for t in texts[at : at + 100]]
            assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == want
        assert asked and (hashed is not hash or len(asked) == len(set(asked)))


def test_cutting_stock_holds_every_piece_in_few_sequences():
    demand = np.random.default_rng(0).integers(0, 40, 64) * (np.arange(64) < 30)
    packed = cutting_stock(demand.astype(float), 64)
    assert (packed.times @ packed.pieces == demand).all()
    assert (packed.pieces @ np.arange(1, 65) <= 64).all()
    assert packed.times.sum() <= np.ceil(demand @ np.arange(1, 65) / 64) * 1.02 + 1


def test_pack(spark, odd, none):
    for docs in (texts_of(spark), odd):
        pieces = pack(docs, with_ids=True).toPandas()
        texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        want = collections.Counter()
        for (i, _), ids in zip(texts, encode([t for _, t in texts], default_tokenizer())):
            ids += np.array([2], "<u4").tobytes()
            for at in range(0, len(ids), 4 * 4096):
                want[i, at // 4, zlib.crc32(ids[at : at + 4 * 4096]), len(ids) // 4] += 1
        plain = lambda i: None if i != i or i is None else int(i)
        got = collections.Counter((plain(r.doc_id), r.start, r.ids_crc32, r.doc_tokens) for r in pieces.itertuples())
        assert got == want
        for _, own in pieces.sort_values("offset").groupby("sequence_id"):
            assert (own["offset"] == own["length"].cumsum() - own["length"]).all() and own["length"].sum() <= 4096
    assert pack(none).count() == 0


def test_a_task_of_the_search_holds_little_text(spark, monkeypatch):
    """An executor holds batches and shards of all its tasks at once, beside what earlier stages left in it."""
    import pyarrow as pa
    from pricelattice.llm import decontaminate
    from pricelattice.session import tune

    tune(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("m")) <= 4
    sizes = []
    whole = decontaminate.occurrences
    monkeypatch.setattr(decontaminate, "occurrences", lambda words, phrases: (sizes.append(len(words.data)), whole(words, phrases))[1])
    text = "a few words of a training text " * 4000
    n = 60
    batch = pa.RecordBatch.from_arrays(
        [pa.array([text] * n), pa.array([[]] * n, pa.list_(pa.int32())), pa.array([[]] * n, pa.list_(pa.string()))], ["text", "hits", "items"]
    )
    phrases = decontaminate._block([], 13)
    found = list(decontaminate._searched(iter([batch]), phrases))
    assert sum(f.num_rows for f in found) == n and sum(sizes) >= n * len(text)
    assert max(sizes) <= (2 << 20) + 2 * len(text)


# ---- 13 grammar files -------------------------------------------------------------------


def test_grammar_files_give_back_every_range():
    rng = np.random.default_rng(4)
    for ids in (np.zeros(0, int), np.zeros(1, int), np.zeros(1000, int), rng.integers(0, 3, 5000), rng.zipf(1.3, 20_000) % 50_000,
                np.tile(rng.integers(0, 70_000, 30), 300)):
        cuts = np.unique(np.concatenate([[0, len(ids)], rng.integers(0, len(ids) + 1, 20)]))
        file = grammar.Reader(grammar.store(ids.astype(np.uint32), cuts))
        assert (file.expand(file.symbols) == ids).all() and (file.lengths >= 2).all()
        assert [file.document(i).tolist() for i in range(len(cuts) - 1)] == [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
        for a, b in np.sort(rng.integers(0, len(ids) + 1, (50, 2)), axis=1):
            assert (file.ids(int(a), int(b)) == ids[a:b]).all()
    assert len(file.symbols) < 1000  # repeated ids have become few symbols


def test_pairs_stay_within_documents():
    ids, first = np.tile([1, 2, 3], 100).astype(np.uint32), np.arange(0, 301, 3)
    file = grammar.Reader(grammar.store(ids, first))
    assert set(np.cumsum(file.sizes(file.symbols))) >= set(first[1:].tolist())


def test_joined_crc32():
    for a, b in ((b"abc", b"defg" * 5), (b"", b"x"), (b"q", b""), (b"\0" * 9, b"\xff" * 1001)):
        assert grammar.joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("size", [1 << 18, 100])
def test_written_ids_are_read_back(spark, odd, none, size):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(grammar.default_tokenizer())
    names = "id text part tie ordinal begin start n_ids content".split()
    clashing = odd.select("*", *[F.lit("mine").alias(n) for n in names if n not in odd.columns])
    for docs in (texts_of(spark), clashing):
        rows = sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        files = grammar.write_ids(docs, size=size)
        assert files.agg(F.max("n_ids")).first()[0] <= size
        got = [tuple(r) for r in grammar.read_ids(files).orderBy("start").collect()]
        start, want = 0, collections.Counter()
        for i, text in rows:
            ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
            want[i, len(ids) // 4, zlib.crc32(ids)] += 1
        assert collections.Counter((i, n, crc) for i, _, n, crc in got) == want
        for i, begin, n, _ in got:  # gapless, in order of id
            assert begin == start
            start += n
        assert [g[0] for g in got] == [r[0] for r in rows]
    assert grammar.read_ids(grammar.write_ids(none)).count() == 0


# ---- 2 decontamination -----------------------------------------------------------------


def test_fm_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    text = rng.integers(1, 5, 3000)
    index = FMIndex(text)
    patterns = np.array([text[i : i + 4] for i in range(0, 400, 7)])
    low, high = index.ranges(patterns, np.full(len(patterns), 4))
    for p, a, b in zip(patterns, low, high):
        places = sorted(index.locate(np.arange(a, b)).tolist())
        assert places == [i for i in range(len(text) - 3) if (text[i : i + 4] == p).all()]


def contaminated(docs, items, size=13):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = collections.defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(len(own) - min(size, len(own)) + 1 if own else 0):
            windows[tuple(own[i : i + size])].add("" if item is None else str(item))
    out = collections.Counter()
    for doc, text in docs:
        own, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(own) - n + 1):
                if names := windows.get(tuple(own[i : i + n])):
                    found |= names
                    hit.update(range(i, i + n))
        out[doc, len(own), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(own)] += 1
    return out


@pytest.mark.parametrize("block", [500_000, 7])
def test_contamination(spark, odd, none, block):
    items = [(1, prose(4, 60)), (2, "one"), (None, "two"), (3, None), (4, "..."), (5, prose(2, 200)), (5, prose(2, 200))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(odd, benchmark, block=block)
    got = collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found.collect())
    assert got == contaminated(ODD, items)
    twelve = found.where("doc_id = 12").first()
    assert [twelve.text[s.start : s.stop] for s in twelve.spans] == [prose(4, 60)]
    assert find_contamination(none, benchmark).count() == 0
    clean = find_contamination(odd, benchmark.limit(0))
    assert clean.where("contaminated or n_hit > 0").count() == 0 and clean.count() == len(ODD)


def test_contamination_of_the_tables(spark):
    if os.path.isdir(SF):
        docs, items = texts_of(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
        got = collections.Counter(
            (r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in find_contamination(docs, items).collect()
        )
        assert got == contaminated([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])


# ---- 3 sharding --------------------------------------------------------------------------


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**60, 3000)
    assert jump_hash(keys, 24).tolist() == [plain_jump(int(k), 24) for k in keys]
    moved = jump_hash(keys, 24) != jump_hash(keys, 25)
    assert (jump_hash(keys, 25)[moved] == 24).all() and 0.02 < moved.mean() < 0.06


def test_shards(spark, odd, none):
    placed = assign_shards(odd).collect()
    assert len(placed) == len(ODD)
    slots = collections.defaultdict(list)
    for r in placed:
        body = (r.text or "").encode()
        key = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16)
        assert (r["size"], r.text_crc32, r.law) == (len(body) + 8, zlib.crc32(body), "key")
        assert (r.shard, r.grown_shard) == (plain_jump(key, 24), plain_jump(key, 25)) and r.kept == "mine"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert assign_shards(none).count() == 0


# ---- 4 passages --------------------------------------------------------------------------


def test_passages(spark, odd, none):
    found = {r.doc_id: r for r in repeated_passages(odd).collect()}
    assert set(found) == {4, 5, 6, 12}  # the row without an id comes first and keeps its text
    assert found[4].kept_in == [None] or found[4].kept_in == []
    assert found[12].kept_in == [11]
    a, b = found[12].gone[0], found[12].gone[-1]
    assert 33 <= a < b <= 93 and b - a >= 24
    cut = {(r.doc_id, r.text) for r in remove_repeats(odd).select("doc_id", "text").collect()}
    assert (7, prose(2, 30_000)) in cut and (2, "") in cut and (1, None) in cut
    assert remove_repeats(odd).columns[:-1] == [c for c in odd.columns if c != "spans"]
    assert remove_repeats(none).count() == 0


def test_every_long_repeat_is_found(spark):
    shared = prose(100, 51)
    rows = [(i, f"{prose(200 + i, 5 + 7 * i)} {shared} {prose(300 + i, 3 * i)}") for i in range(20)]
    rows += [(100 + i, prose(500 + i, 200)) for i in range(20)]
    near = prose(600, 60).split()
    rows += [(200, " ".join(near)), (201, " ".join([*near[:30], "changed", *near[31:]]))]
    found = {r.doc_id for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == set(range(1, 20)) | {201}


def gone_words(spark, rows):
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: {w for a, b in zip(r.gone[0::2], r.gone[1::2]) for w in range(a, b)} for r in found}


def test_repeats_of_short_lines_are_covered(spark):
    """Lines of 5 words over and over, of one word, and texts next to each other that end and begin alike."""
    menu = "\n".join(["home news about shop contact"] * 40)
    rows = [(i, f"{prose(800 + i, 30 + i)}\n{menu}\n{prose(810 + i, 30)}") for i in range(3)]
    rows += [(10 + i, f"{prose(820 + i, 40)} {'spam ' * 300}{prose(830 + i, 40)}") for i in range(2)]
    rows += [(20, prose(840, 30) + " " + "again " * 60), (21, "again " * 60 + prose(841, 30))]
    gone = gone_words(spark, rows)
    assert set(gone) == {1, 2, 11, 21}
    for i, begin, size in ((1, 31, 200), (2, 32, 200), (11, 40, 300), (21, 0, 60)):
        own = gone[i] & set(range(begin, begin + size))
        assert gone[i] == own and len(own) > size - 24


def test_passages_are_cut_to_their_ends(spark):
    """Planted passages go whole, whichever of the earlier documents has all of their words, at the ends of texts and over lines."""
    rows, planted = [], {}
    for n in range(30):
        size = 51 + n
        shared = prose(1000 + n, size).split()
        for copy in range(3):
            before, after = prose(2000 + 10 * n + copy, 35 * copy), prose(3000 + 10 * n + copy, 40 if n % 2 else 0)
            rows.append((10 * n + copy + 1, f"{before} {chr(10).join([' '.join(shared[:10]), ' '.join(shared[10:])]) if copy == 1 else ' '.join(shared)} {after}"))
            if copy:
                planted[10 * n + copy + 1] = set(range(35 * copy, 35 * copy + size))
        # an earlier document with the middle of the passage only
        rows.append((10 * n, f"{prose(4000 + n, 30)} {' '.join(shared[2:-2])} {prose(5000 + n, 30)}"))
        planted[10 * n + 1] = set(range(2, size - 2))
    gone = gone_words(spark, rows)
    assert {i: w for i, w in gone.items() if i in planted} == planted


def test_covering_windows_cover_what_all_cover():
    rng = np.random.default_rng(3)
    for _ in range(200):
        at = np.unique(rng.integers(0, 400, 60))
        node, text = np.sort(rng.integers(0, 4, len(at))), np.sort(rng.integers(0, 3, len(at)))
        some = covering(at, node, text, 24)
        cover = lambda take: {(n, t, w) for a, n, t in zip(at[take], node[take], text[take]) for w in range(a, a + 24)}
        assert cover(some) == cover(np.ones(len(at), bool))
    assert covering(np.arange(10_000), np.zeros(10_000), np.zeros(10_000), 24).sum() < 420


def test_tuned_bands():
    bands, rows = tune_bands(0.75, 0.98)
    assert 1 - (1 - 0.75**rows) ** bands >= 0.98


# ---- 5 top k ---------------------------------------------------------------------------


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]  # ties
    rows += [(500, None), (501, [float("nan")] + [0.0] * 7), (502, [float("inf")] + [0.0] * 7), (503, [None] + [0.0] * 7), (None, [1.0] * 8),
             (504, [9.0]), (505, [9.0, -1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 0.0]), (505, [1.0] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[n] = i, np.floor(64 * np.pad(np.array(v, np.float32).astype(float), (0, 8 - len(v)))).astype(int)
    want = []
    for i, q in good.values():
        if i % 20 == 0:
            best = sorted((-int(q @ v), j) for j, v in good.values() if j != i)[:20]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    for chunk in (64, 4096):
        got = exact_top_k(vectors, vectors.where("vec_id % 20 = 0"), 20, chunk=chunk, query_chunk=16, block=16, sample=40)
        assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert exact_top_k(vectors.limit(0), vectors, 20).count() == 0
    few = vectors.where("vec_id < 3")
    assert exact_top_k(few, few, 20).count() == 6


# ---- 6 fixity ----------------------------------------------------------------------------


def test_audit(spark):
    rows = [(i, f"http://h/{i}", f"<p>{prose(i, 40)}</p>") for i in range(700)] + [(None, None, None), (5, "http://h/5", "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = pages.select("page_id", "url", warc_fixity.warc_record(F.col("url"), F.col("page_id"), F.col("html")).alias("record"))
    index = warc_fixity.record_index(records, ["page_id", "url"], per_file=300).cache()
    assert index.groupBy("file").count().count() == 3
    changed = F.col("page_id").isin(3, 400)
    replica = index.where("page_id is null or page_id <> 77").withColumn("digest", F.when(changed, "x").otherwise(F.col("digest"))).withColumn(
        "length", F.when(F.col("page_id") == 600, 1).otherwise(F.col("length"))
    )
    got = {(r.page_id, r.kind) for r in warc_fixity.audit(index, replica, span=2048, fanout=4, carry=["page_id"]).collect()}
    assert got == {(3, "changed"), (400, "changed"), (77, "missing"), (600, "length")}
    extra = warc_fixity.audit(replica, index, span=2048, carry=[]).where("kind = 'extra'").count()
    assert extra == 1
    assert warc_fixity.audit(index, index).count() == 0
    assert warc_fixity.audit(index.limit(0), index.limit(0)).count() == 0


# ---- 7 near duplicates -------------------------------------------------------------------


def shingle_set(text, n=5):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def plain_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    groups = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[root(i)].append(doc)
    least = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return collections.Counter((d, len(s), least[root(i)], d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_sketch_agrees_like_the_sets():
    rng = np.random.default_rng(5)
    for n in (1, 3, 40, 900):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        assert len(sketch(a, 96)) == 96 and (sketch(a, 96) < 2**64 - 1).all()
    a = rng.integers(0, 2**63, 800).astype(np.uint64)
    same = (sketch(a, 2000) == sketch(np.concatenate([a[:600], a[:200] + np.uint64(1)]), 2000)).mean()
    assert abs(same - 0.6) < 0.06
    assert len(band_keys(sketch(a, 96), 3)) == 32


def test_near_duplicates(spark, odd, none):
    got = near_duplicates(odd)
    assert got.columns == [c for c in odd.columns if c != "kept"] + ["n_shingles", "component_id", "kept"]
    rows = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect())
    assert rows == plain_components(ODD)
    assert near_duplicates(none).count() == 0


def test_groups_of_edited_copies(spark):
    rng = np.random.default_rng(8)
    rows = []
    for group in range(3):
        base = prose(700 + group, 120).split()
        for _ in range(130):
            edited = list(base)
            for _ in range(rng.integers(0, 12)):
                edited[rng.integers(len(edited))] = str(rng.integers(4))
            rows.append((int(rng.integers(10**9)), " ".join(edited)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).drop("text").collect())
    assert got == plain_components(rows)


def test_common_and_spanning():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[:20]] for a in sets]
    assert common(sets, sets[:20], width=16).tolist() == want
    linked = np.zeros((3, 3), bool)
    linked[0, 2] = linked[1, 0] = True
    assert spanning(linked, False).tolist() == [0, 1, 2, 1, 4, 0]


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100}


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("o"))
    got = collections.defaultdict(list)
    for r in numbered(df, ["k"], ["o"], "n").collect():
        got[r.k].append((r.n, r.o))
    assert all([n for n, _ in sorted(v)] == list(range(len(v))) and [o for _, o in sorted(v)] == sorted(o for _, o in v) for v in got.values())


# ---- 8 URLs ------------------------------------------------------------------------------

RULES = [link_trust.Rule("block", "net", "/"), link_trust.Rule("allow", "example.net", "/en/"), link_trust.Rule("block", "bad.org", "/")]


def plain_rank(links, seeds, damping, rounds):
    out = collections.Counter()
    for s, _, w in links:
        out[s] += w
    total = sum(seeds.values())
    score = {h: w / total for h, w in seeds.items()}
    for _ in range(rounds):
        new = collections.Counter()
        for s, d, w in links:
            new[d] += damping * score.get(s, 0) * w / out[s]
        rest = 1 - sum(new.values())
        for h, w in seeds.items():
            new[h] += rest * w / total
        score = new
    return score


def test_urls_and_rules(spark):
    urls = ["HTTP://A.Example.NET/en/x?y", "http://example.net", "http://net/", "x", None, "a://b?c://d/e", "a://xnet/en/", "a://y.net/en/"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id int, url string, html string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in link_trust.judge_urls(pages, RULES).orderBy("page_id").collect()]
    assert got == [
        ("a.example.net", "/en/x", "example.net/en/", "allow"), ("example.net", "", None, "allow"), ("net", "/", "net/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("b", "", None, "allow"), ("xnet", "/en/", None, "allow"),
        ("y.net", "/en/", "net/", "block"),
    ]
    assert link_trust.judge_urls(pages.limit(0), RULES).count() == 0


def test_distrust_flows_to_those_who_link(spark):
    pages = spark.createDataFrame([
        (1, "http://bad.org/a", '<a href="http://far.com/">'), (2, "http://friend.com/a", "<A HREF='//bad.org/x'>"),
        (3, "http://clean.com/a", '<a href="/b"><img src="https://example.net/en/">'), (4, "http://example.net/en/a", '<a href="http://clean.com">'),
        (5, "http://far.com/", None),
    ], "page_id int, url string, html string")
    got = {r.page_id: r.verdict for r in link_trust.judge_urls(pages, RULES, threshold=0.3).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_hosts_without_pages_are_seeds(spark):
    """A blocked target that was not crawled makes its linkers suspect; a trusted one hands its trust on by its path."""
    pages = spark.createDataFrame([
        (1, "http://friend.com/a", '<a href="http://Spam.net/x?y">'), (2, "http://clean.com/a", '<a href="http://example.net/en/b">'),
        (3, "http://other.com/a", '<a href="http://nowhere.com/">'), (4, "http://path.com/a", "<a href='//www.half.com/bad/1'>"),
    ], "page_id int, url string, html string")
    rules = [*RULES, link_trust.Rule("block", "half.com", "/bad/")]
    got = {r.page_id: r for r in link_trust.judge_urls(pages, rules, threshold=0.3).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "allow", 3: "allow", 4: "block"}
    assert got[1].distrust > 0.3 and got[4].distrust > 0.3 and got[2].distrust == got[3].distrust == 0
    seen = {(r.host, r.path) for r in link_trust.linked_urls(pages).collect()}
    assert seen == {("spam.net", "/x"), ("example.net", "/en/b"), ("nowhere.com", "/"), ("www.half.com", "/bad/1")}


def test_propagation_is_personalised_pagerank(spark):
    links = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "c", 1), ("b", "e", 1)]
    seeds = {"a": 1.0, "d": 3.0}
    got = link_trust.propagate(
        spark.createDataFrame(links, "src string, dst string, weight long"),
        spark.createDataFrame([(h, w / 4) for h, w in seeds.items()], "host string, share double"), 0.85, 60,
    )
    want = plain_rank(links, seeds, 0.85, 200)
    assert {r.host: round(r.score, 4) for r in got.collect()} == {h: round(s, 4) for h, s in want.items()}


def test_propagation_ends_when_little_is_left_to_arrive(spark):
    """Against the solved system, with links that let scores circle for long."""
    rng = np.random.default_rng(8)
    n = 40
    links = [(int(a), int(b), int(w)) for a, b, w in zip(rng.integers(0, n, 90), rng.integers(0, n, 90), rng.integers(1, 5, 90)) if a != b]
    weights = np.zeros((n, n))
    for a, b, w in links:
        weights[b, a] += w
    moves = 0.95 * weights / np.maximum(weights.sum(axis=0), 1)
    source = np.zeros(n)
    source[:4] = 0.25
    want = np.linalg.solve(np.eye(n) - moves, source)
    got = link_trust.propagate(
        spark.createDataFrame([(f"h{a}", f"h{b}", w) for a, b, w in links], "src string, dst string, weight long"),
        spark.createDataFrame([(f"h{i}", 0.25) for i in range(4)], "host string, share double"), damping=0.95, tolerance=1e-6,
    )
    got = {r.host: r.score for r in got.collect()}
    assert sum(abs(got.get(f"h{i}", 0) - want[i] / want.sum()) for i in range(n)) < 1e-5


# ---- names ---------------------------------------------------------------------------------

#: Every name that a result or a step bears.
NAMES = sorted({*"""_id _key _hash gone _n _c _root _first _p _at _part _least _group _leads _label _lang _tie _doc key node bucket
lead n a b u v m root part nth start stop windows more also_in keeper spans kept kept_in n_shingles component_id size text_crc32 law shard
slot grown_shard score predicted margin rejected lang_pred n_words n_hit n_items items contaminated ids ids_crc32 length doc_tokens sequence_id
offset host path rule verdict trust distrust file digest label c0 c1 c2 id tie at p shift units piece rank""".split()} - {"doc_id", "text"})


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else "de", *["mine"] * len(NAMES)) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in NAMES))


def test_columns_of_any_name(spark, clashing):
    """All operators take a table whose columns bear the names of results and steps, and keep those that are no result."""
    plain = clashing.select("doc_id", "text", "lang")
    value = lambda df, columns: collections.Counter(tuple(str(x) for x in r) for r in df.select(*columns).collect())

    def same(op, result):
        wide, narrow = op(clashing), op(plain)
        assert value(wide, result) == value(narrow, result)
        for name in set(wide.columns) & set(NAMES) - set(narrow.columns):
            assert {r[0] for r in wide.select(f"`{name}`").collect()} == {"mine"}, name

    same(near_duplicates, ["doc_id", "text", "n_shingles", "component_id", "kept"])
    same(remove_repeats, ["doc_id", "text", "spans"])
    same(assign_shards, ["doc_id", "size", "text_crc32", "shard", "slot", "grown_shard"])
    benchmark = spark.createDataFrame([(1, prose(4, 60)), (2, "one")], "item_id long, text string")
    same(lambda d: find_contamination(d, benchmark), ["doc_id", "n_words", "n_hit", "contaminated"])
    same(pack, ["doc_id", "start", "length", "ids_crc32"])
    dictionaries = language.learn_dictionaries(clashing)
    assert dictionaries == language.learn_dictionaries(plain) and len(dictionaries) == 2
    same(lambda d: language.identify(d, dictionaries), ["doc_id", "lang_pred", "score", "rejected"])
    labels = clashing.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), *[f"`{n}`" for n in NAMES])
    one, two = (quality_crf.learn(d, q) for d, q in ((clashing, labels), (plain, labels.select("doc_id", "quality"))))
    assert (one.weights == two.weights).all()
    same(lambda d: quality_crf.score_quality(d, one), ["doc_id", "score", "predicted"])
    records = lambda d: d.withColumn("record", F.coalesce("text", F.lit("")).cast("binary"))
    same(lambda d: warc_fixity.record_index(records(d), ["doc_id", "text"]), ["doc_id", "file", "offset", "length", "digest"])


def test_stages_take_columns_of_any_name(spark, clashing):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, clashing, SF)
        if name != "packing":
            assert out.columns == clashing.columns, name
            assert {tuple(r) for r in out.select(*[f"`{n}`" for n in NAMES]).distinct().collect()} <= {("mine",) * len(NAMES)}
        assert 0 < out.count() <= 60


# ---- 9 quality ---------------------------------------------------------------------------


def test_forward_backward_is_the_sum_over_all_labellings():
    rng = np.random.default_rng(0)
    lines = quality_crf.lines_of(["one two\nTHREE!!\n#### ****\n\nfive", "", None, "a\nb"])
    model = quality_crf.Model(rng.normal(size=quality_crf.N_FEATURES), rng.normal(size=(2, 2)))
    good, _ = quality_crf.marginals(model, lines)
    for a, b in zip(lines.first, lines.first[1:]):
        evidence = model.weights[lines.features[a:b]].sum(axis=1)
        weight, on = 0.0, np.zeros(b - a)
        for code in range(2 ** (b - a)):
            label = [(code >> i) & 1 for i in range(b - a)]
            w = np.exp(sum(e for e, y in zip(evidence, label) if y) + sum(model.steps[x, y] for x, y in zip(label, label[1:])))
            weight, on = weight + w, on + w * np.array(label)
        assert np.allclose(good[a:b], on / weight)
    assert np.diff(lines.first).tolist() == [5, 1, 1, 2]


def test_quality(spark, odd, none):
    docs, labels = texts_of(spark, "/root/testdata/sf0.01"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = language.held_out(F.col("doc_id"), 4, 2)
    model = quality_crf.learn(docs.where(~out), labels.where(~out))
    found = quality_crf.score_quality(docs.where(out), model).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.95
    scored = quality_crf.score_quality(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    blank = quality_crf.learn(none, labels)
    assert {r.score for r in quality_crf.score_quality(odd, blank).collect()} == {0.5}
    assert quality_crf.score_quality(none, model).count() == 0


# ---- 10 language ---------------------------------------------------------------------------


def test_language(spark, odd, none):
    docs = texts_of(spark, "/root/testdata/sf0.01")
    out = language.held_out(F.col("doc_id"), 3, 1)
    known = language.learn_dictionaries(docs.where(~out))
    found = language.identify(docs.where(out & F.col("lang").isNotNull()), known).collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95
    got = {r.doc_id: r for r in language.identify(odd, known).where("doc_id is not null").collect()}
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (1, 2, 3))
    assert got[4].lang_pred in known and 0 <= got[4].score <= 1 and got[4].kept == "mine"
    assert {r.lang_pred for r in language.identify(odd, {}).collect()} == {"und"}
    assert language.learn_dictionaries(none) == {} and language.identify(none, known).count() == 0


def test_the_margin_does_not_fade_with_length(spark):
    """10 MB of one language, of texts that the dictionaries do not hold, are told as surely as 100 KB of it."""
    docs = texts_of(spark, "/root/testdata/sf0.01").where("lang = 'en' and text is not null")
    out = language.held_out(F.col("doc_id"), 3, 1)
    known = language.learn_dictionaries(texts_of(spark, "/root/testdata/sf0.01").where(~out))
    words = " ".join(r.text for r in docs.where(out).orderBy("doc_id").select("text").collect()).split()
    rng = np.random.default_rng(0)
    long = " ".join(words[i] for i in rng.integers(0, len(words), 2_200_000))[: 10 << 20]
    assert len(long) > 9.5e6
    rows = spark.createDataFrame([(0, long[:100_000]), (1, long)], "doc_id long, text string")
    short, whole = language.identify(rows, known).orderBy("doc_id").collect()
    assert short.lang_pred == whole.lang_pred == "en" and not whole.rejected
    assert whole.margin > short.margin / 2


def test_held_out(spark):
    got = spark.range(50).select("id", language.held_out(F.col("id"), 3, 1).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
