"""Fill-in-the-middle examples and the prefix trie against plain versions."""

import collections
import hashlib
import random
import zlib

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pricelattice.llm import fill_in_middle as M
from pricelattice.llm import prefix_trie as T

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_prefix_trie"])
def test_against_duckdb(spark, name):
    assert compare.compare(spark, compare.connect(SF), SF, name) is None


# ---- 11 fill in the middle ----------------------------------------------------------------


def example(i, text):
    """The example as the rules give it: (n, form, prefix, middle, output)."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [(None, None), (None, "text without an id"), (1, ""), (2, None), (3, "a"), (4, "é漢\U0001F600" * 50), (5, "x" * 100_000), (6, "has <S> in it"),
       (7, "almost <S <P M> <M"), (8, "<"), (9, "P>S>M>"), (3, "a"), (3, "b"), (10, "line\n" * 3000), *((i, f"text {i} <" + "y" * (i % 37)) for i in range(20, 120))]


@pytest.mark.parametrize("units", [1, 7, 1 << 14])
def test_examples(spark, units):
    extra = ["frames", "n", "marked", "form", "id", "start", "output_sha256", "doc_id2"]
    rows = [r for r in ODD if units > 1 or len(r[1] or "") < 1000]
    docs = spark.createDataFrame([(*r, *["mine"] * len(extra)) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in extra))
    frames = M.store_frames(docs, units=units)
    assert {u for r in frames.collect() for u in [f.units for f in r.frames][:-1]} <= {units}
    examples = M.fill_in_middle(frames)
    got = collections.Counter()
    for r in M.digests(examples).collect():
        got[r.id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256] += 1
    want = collections.Counter()
    for i, text in rows:
        n, form, a, b, output = example(i, text)
        want[i, n, form, a, b, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want
    import zstandard

    for r in examples.collect():  # an example is a run of frames that any reader can read
        text = b"".join(zstandard.ZstdDecompressor().decompress(f.code) for f in r.frames).decode()
        assert text in {example(i, t)[4] for i, t in rows if i == r.id}
        assert [f.start for f in r.frames] == [sum(g.units for g in r.frames[:k]) for k in range(len(r.frames))]


def test_a_cut_opens_one_frame():
    import pyarrow as pa

    text = "".join(chr(0x4E00 + i % 5000) for i in range(10_000))
    docs = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([False])], ["id", "text", "marked"])
    (stored,) = M._stored(iter([docs]), 100, 3)
    frames = M.Frames(stored["frames"][0])
    opened = []
    inner = frames.text
    frames.text = lambda i: opened.append(i) or inner(i)
    runs = frames.run(0, 4321) + frames.run(4321, 8000) + frames.run(8000, 10_000)
    assert sum(n for n, _ in runs) == len(text) and set(opened) == {43}


def test_no_examples_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert M.digests(M.fill_in_middle(M.store_frames(none))).count() == 0


# ---- 12 prefix trie ----------------------------------------------------------------------


def plain_trie(rows, block=100, most=5):
    """Every node by brute force, from (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            own[c].append((turn is not None, turn or 0, role or "", hashlib.md5(text.encode()).hexdigest(), text))
    own = {c: [(r, x) for _, _, r, _, x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        base = c - (abs(c) % block) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m != n and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return collections.Counter(out)


def found(df):
    return collections.Counter(tuple(r) for r in df.select(*T._RESULT).collect())


def conversations(seed, n):
    """Few words, so that beginnings are shared; copies of whole conversations, single turns, ties, nulls, a long one."""
    rng = random.Random(str(seed))
    rows = []
    for c in rng.sample(range(-250, 900), n):
        turns = rng.choice([0, 1, 1, 2, 3, 7]) if rng.random() < 0.6 else -1
        path = [("user", "hi"), ("bot", "hello é"), ("user", "and?"), ("bot", "ok")] if turns < 0 else [
            (rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "", None, "漢字"])) for _ in range(turns)]
        order = rng.sample(range(50), len(path))
        rows += [(c, sorted(order)[i] if rng.random() < 0.95 else 7, *t) for i, t in enumerate(path)]
        if path and rng.random() < 0.1:
            rows.append((c, None, "system", "first"))
            rows.append((c, 3, *path[0]))
    rows += [(1000, i, "user", f"t{i % 3}") for i in range(30)] + [(1001, i, "user", f"t{i % 3}") for i in range(29)] + [(1100, i, "user", "t0") for i in range(30)]
    return [*rows, (None, 1, "user", "hi"), (None, None, None, None)]


@pytest.mark.parametrize("shard_rows, max_depth, held", [(20_000, 64, 9), (10, 64, 9), (3, 64, 20_000), (7, 2, 1), (20_000, 1, 1), (5, 5, 1)])
def test_prefix_trie(spark, monkeypatch, shard_rows, max_depth, held):
    monkeypatch.setattr(T, "_HELD", held)
    rows = conversations(shard_rows, 120)
    extra = ["conv", "pos", "key", "node", "depth", "kind", "h", "total", "head"]
    table = spark.createDataFrame([(*r, *["mine"] * len(extra)) for r in rows], "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in extra))
    got = found(T.prefix_trie(T.rebuilt(T.numbered_turns(table)), shard_rows=shard_rows, max_depth=max_depth))
    assert got == plain_trie(rows)


def test_copies_of_one_conversation_lie_in_several_shards(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    turns = T.rebuilt(T.numbered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert found(T.prefix_trie(turns, shard_rows=20)) == plain_trie(rows)


def test_no_nodes_without_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert T.prefix_trie(T.rebuilt(T.numbered_turns(none))).count() == 0
    null = spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert T.prefix_trie(T.rebuilt(T.numbered_turns(null))).count() == 0


# ---- 4 passages: layout and the whole result --------------------------------------------


def words(seed, n):
    rng = random.Random(str(seed))
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


@pytest.mark.parametrize("width", [60, 30, 12, 7, 1])
def test_near_copies_are_found_in_lines_of_any_width(spark, width):
    """Paragraphs of 60 words with one word changed, wrapped alike or not, between others and blank lines."""
    from pricelattice.llm.passage_dedup import repeated_passages

    rows, pairs = [], 100
    wrapped = lambda w, at: "\n".join(" ".join(w[i : i + at]) for i in range(0, len(w), at))
    for p in range(pairs):
        body = words(("p", p), 60)
        copy = list(body)
        copy[random.Random(p).randrange(60)] = "changed"
        for side, text in enumerate((body, copy)):
            around = [words((p, side, k), 40) for k in range(2)]
            rows.append((2 * p + side, "\n\n".join([wrapped(around[0], width), wrapped(text, width), wrapped(around[1], width)])))
    found = {r.doc_id: r.gone for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) <= {2 * p + 1 for p in range(pairs)}
    whole = [found.get(2 * p + 1) == [40, 100] for p in range(pairs)]
    assert sum(whole) >= 0.99 * pairs, [found.get(2 * p + 1) for p in range(pairs) if not whole[p]]


def plain_repeats(rows, least, length=24, percent=75):
    """Which words an earlier document has, too, by comparing all pairs: equal or near paragraphs, and equal stretches of ``least`` words or more."""
    docs = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    texts, units = [], []
    for n, (_, text) in enumerate(docs):
        at, run = 0, []
        own = text.encode().lower().split()
        texts.append(own)
        for line in [*text.split("\n"), ""]:
            count = len(line.split())
            if run and (count >= length or not count):
                if run[1] - run[0] >= length:
                    units.append((n, *run))
                run = []
            if count >= length:
                units.append((n, at, at + count))
            elif count:
                run = [run[0] if run else at, at + count]
            at += count
    sets = [{tuple(texts[n][i : i + 5]) for i in range(a, b - 4)} for n, a, b in units]
    root = list(range(len(units)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(units)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    gone = collections.defaultdict(set)
    first = {}
    for i, (n, _, _) in enumerate(units):
        first[find(i)] = min(first.get(find(i), n), n)
    for i, (n, a, b) in enumerate(units):
        if first[find(i)] < n:
            gone[n].update(range(a, b))
    for n in range(len(texts)):
        for m in range(n):
            for a in range(len(texts[n])):
                for b in range(len(texts[m])):
                    if (a and b and texts[n][a - 1] == texts[m][b - 1]) or texts[n][a] != texts[m][b]:
                        continue
                    k = 0
                    while a + k < len(texts[n]) and b + k < len(texts[m]) and texts[n][a + k] == texts[m][b + k]:
                        k += 1
                    if k >= least:
                        gone[n].update(range(a, a + k))
    return {docs[n][0]: g for n, g in gone.items()}


@pytest.mark.parametrize("together", [10_000, 2])
def test_whole_result_of_passages(spark, monkeypatch, together):
    """Planted passages, near paragraphs and noise; also with every window's occurrences looked up by hashes."""
    from pricelattice.llm import passage_dedup

    monkeypatch.setattr(passage_dedup, "TOGETHER", together)
    rng = random.Random(5)
    passages = [words(("q", k), rng.choice([51, 55, 64, 90, 130])) for k in range(5)]
    near = [words(("n", k), 40) for k in range(3)]
    rows = []
    for i in range(24):
        parts = [words(("u", i, k), rng.randint(3, 30)) for k in range(3)]
        if rng.random() < 0.8:
            parts.insert(rng.randrange(4), rng.choice(passages))
        text = " ".join(" ".join(p) for p in parts)
        if rng.random() < 0.5:
            edited = list(rng.choice(near))
            edited[rng.randrange(40)] = f"edit{i % 2}"
            text += "\n" + " ".join(edited) + "\n" + " ".join(words(("t", i), 10))
        rows.append((i, text))
    got = {
        r.doc_id: {w for a, b in zip(r.gone[0::2], r.gone[1::2]) for w in range(a, b)}
        for r in passage_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    }
    # every repeat of 51 words goes whole; shorter ones, down to 24 words, where an anchor lies in them; nothing else
    surely, perhaps = plain_repeats(rows, 51), plain_repeats(rows, 24)
    assert len(surely) > 10 and set(surely) <= set(got) <= set(perhaps)
    for doc, gone in got.items():
        assert surely.get(doc, set()) <= gone <= perhaps[doc], doc


# ---- 10 language: the code lengths, recomputed ---------------------------------------------


def test_language_is_that_of_the_shortest_code(spark):
    import zstandard

    from pricelattice.llm import language

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    dictionaries = language.learn_dictionaries(docs, texts_per_language=60, bytes_per_language=40_000)
    names = sorted(dictionaries)
    raw = [zstandard.ZstdCompressionDict(dictionaries[n], dict_type=zstandard.DICT_TYPE_RAWCONTENT) for n in names]
    seen = 0
    for r in language.identify(docs.where("doc_id < 150"), dictionaries).collect():
        code = language.plain(r.text or "").encode()
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        pieces = [code[at : at + language.PIECE] for at in range(0, len(code), language.PIECE)]
        sizes = [sum(len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d).compress(p)) for p in pieces) for d in raw]
        best = sorted(sizes)
        if best[1] - best[0] > 3:  # frame headers aside, the same code
            assert r.lang_pred == names[sizes.index(best[0])]
            seen += 1
    assert seen > 100


def test_two_languages_alike_are_a_tie(spark):
    from pricelattice.llm import language

    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "")], "doc_id long, text string")
    (row, empty) = language.identify(docs, {"b": b"one two three four", "a": b"one two three four"}).orderBy("doc_id").collect()
    assert (row.lang_pred, row.margin, row.rejected) == ("a", 0.0, True) and empty.lang_pred == "und"
