"""Spelling variants, exact top-k search and the alignment of two tokenizers: queries against brute force, and odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_plain import plain_segmentation
from stemma.llm import alignment, bpe, language_id, lm, queries, spelling, topk, toxicity

FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows, every=199):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def plain_variants(words):
    by_size, near = defaultdict(list), defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    for w in words:
        near[w] = [x for size in (len(w) - 1, len(w), len(w) + 1) for x in by_size[size] if one_edit(w, x)]
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), None if form[w] is None else words[form[w]]))
    return out


def told(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def documents(folder=FOLDER):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]


def test_spelling_query_is_brute_force(spark):
    got = queries.op11_spelling(spark, FOLDER)
    expected = plain_variants(plain_words(documents()))
    assert told(got) == expected and got.count() == len(expected) and any(r[1] for r in expected)


def test_variants_of_random_words(spark):
    """Few letters, so that many words are near, with chains of forms, accents, ties and long words."""
    draw = random.Random(3)
    chain = ["abcdefgh", "abcdefgx", "abcdefxx", "abcdexxx"]
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(zip(chain, (5, 25, 125, 625)))]
    pool = ["".join(draw.choice("abéÀ") for _ in range(draw.randint(5, 9))) for _ in range(900)]
    rows += [(1000 + k, " ".join(draw.choice(pool) for _ in range(60))) for k in range(400)]
    long = "ab" * 20_000
    rows += [(5000, " ".join([long] * 5 + [long + "c"] * 30 + [long[:9_999] + long[10_000:]] * 5)), (None, None), (6000, ""), (6001, "÷×ÄÖÜß ÄÖÜßé÷×÷")] * 6
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n long")
    for every in (199, 3):
        assert told(spelling.variants(docs, every)) == plain_variants(plain_words(rows, every))
    assert {r.word: r.root for r in spelling.variants(docs, 10**12).collect()}[chain[0]] == chain[-1]


def test_no_words(spark):
    for rows in ([], [(1, None)], [(1, "short words of no use"), (2, "")]):
        assert spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


def plain_topk(rows, every=100, k=10):
    whole = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for i, q in {(i, tuple(v)) for i, v in whole if i is not None and i % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j) for j, v in whole if j != i)
        out.update((i, rank + 1, j, -s) for rank, (s, _, j) in enumerate(scored[:k]))
    return out


def ranked(df):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1.0, b"") for i, v in rows], "vec_id long, embedding array<float>, score double, data binary")


def test_topk_query_is_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()]
    assert ranked(queries.op12_topk(spark, FOLDER)) == plain_topk(rows)


def test_topk_of_odd_vectors(spark):
    """Blocks of few rows, so that bounds, ties and routes decide; copies, negatives, zeros, nulls, other lengths."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=8) * 0.05]) for i in range(400)]
    rows += [(1000 + i, rows[6][1]) for i in range(150)] + [(2000 + i, [0.0] * 8) for i in range(20)]
    rows += [(300, None), (None, rows[1][1]), (None, rows[6][1]), (500, [None, 1.0]), (600, [float("nan")] * 8), (700, [float("inf")] * 8), (800, []), (900, [0.5, -0.5]), rows[0], rows[100], (100, [1.0] * 8), (3000, [-1.0] * 12)]
    df = vectors(spark, rows)
    assert ranked(topk.search(df, block=4, blocks=3)) == plain_topk(rows)
    assert ranked(topk.search(df, 7, 3, block=5, blocks=2)) == plain_topk(rows, 7, 3)


def test_topk_of_few_rows(spark):
    for rows in ([], [(0, None)], [(0, [1.0])], [(0, [1.0]), (1, [2.0])], [(1, [1.0])], [(0, []), (100, [])], [(0, [1e30, 1.0]), (1, [2.0, 1.0]), (2, [-1.0, 1.0])]):
        small = [r for r in rows if r[1] is None or all(abs(x) < 1e6 for x in r[1])]
        got = ranked(topk.search(vectors(spark, rows)))
        assert got == plain_topk(rows) if small == rows else sorted(got) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63) + 1)]


def test_blocks_are_pruned():
    """Where vectors come in groups, a query whose k-th score is known leaves most blocks closed."""
    rng = np.random.default_rng(2)
    rows = np.repeat(rng.integers(-100, 100, (8, 16)), topk.BLOCK, axis=0).astype(float) + rng.integers(-2, 3, (8 * topk.BLOCK, 16))
    part = topk.Range(np.arange(len(rows), dtype=np.int64), rows)
    bound = topk.bounds(rows[:1], part.most, part.least)[0]
    best, _ = part.search(np.array([0]), rows[:1], np.array([topk.NONE]), np.array([topk.LAST]), 10)
    assert (bound >= best[0, -1]).sum() == 1 and best[0, 0] == np.sort(rows[1:] @ rows[0])[-1]


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


BYTES = bpe.piece_bytes(public_tokenizers.path("byte_bpe_50k.json"))


def piece_of(model, i):
    p = model.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()


def plain_groups(text, coders):
    if not text:
        return []
    a_ids, b_ids = coders[0].encode(" " + text, add_special_tokens=False).ids, coders[1].encode(text)
    a, b = [BYTES[i] for i in a_ids], [piece_of(coders[1], i) for i in b_ids]
    if not (b"".join(a) == b"".join(b) == (" " + text).encode()):
        return []
    ends_a, ends_b = np.cumsum([len(x) for x in a]), np.cumsum([len(x) for x in b])
    groups, i, j = [], 0, 0
    for cut in sorted({*ends_a.tolist()} & {*ends_b.tolist()}):
        to_i, to_j = np.searchsorted(ends_a, cut, "right"), np.searchsorted(ends_b, cut, "right")
        groups.append((a_ids[i:to_i], b_ids[j:to_j]))
        i, j = to_i, to_j
    return groups


def plain_alignment(rows, coders):
    each = [(i, plain_groups(t, coders)) for i, t in rows]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in each]
    count = Counter(p for x in links for p in x)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (i, g), own in zip(each, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), own.total(), sum(n for p, n in own.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in own.items()), written))
    return out


def rows_of(df, last):
    return [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r[last]) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_alignment_query_is_brute_force(spark, coders):
    expected = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in plain_alignment(documents(), coders)]
    assert ordered(rows_of(queries.op13_alignment(spark, FOLDER), "groups_sha256")) == ordered(expected)


def test_alignment_of_odd_texts(spark, coders):
    """Lots and batches of few bytes; blanks and other white space anywhere, marks of the pieces, special strings, other scripts, long texts."""
    draw = random.Random(1)
    texts = [None, "", " ", "  ", "\n", "a ", " a", "a  b", "a \n b", "a\n b\n  c ", "a  b", "\x1c a \x1d", "a▁b", "x ▁", "<s> </s> <unk> <|endoftext|> <0x41>", "日本語 の テキスト", "é é ﬁ", "it's we'll I'd", "\0 a\0", "😀 👩‍👩‍👧 x", "\r\n\t", "a　 b", "ab" * 20_000, " " * 5_000, "word " * 3_000]
    texts += ["".join(draw.choice([" ", "a", "b", "\n", "é", "1", "'s", "日", "\t", "😀", "the", ".", "  "]) for _ in range(draw.randint(1, 60))) for _ in range(300)]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(1, "it's we'll I'd")] * 3
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, lot long, words string")
    got = alignment.align(docs, ["doc_id", "lot", "words"], size=3_000, batch=500)
    assert ordered(rows_of(got, "groups")) == ordered(plain_alignment(rows, coders)) and {(r.lot, r.words) for r in got.collect()} == {(1, "x")}
    with pytest.raises(ValueError):
        alignment.align(docs.withColumnRenamed("words", "N_A"), ["N_A"])
    assert alignment.align(docs.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\ta1é日'.  \x1cs"), max_size=30))
def test_segments_are_tokenized_alone(text):
    """But for texts with the pieces' mark of a blank, which have no tokens, a text's ids are those of its segments."""
    model = alignment.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    encode = bpe.encoder(public_tokenizers.path("byte_bpe_50k.json"), special=False)
    parts = alignment.segments(text)
    assert "".join(parts) == " " + text
    if text:
        assert sum(model.encode(parts), []) == model.model.encode(text)
    assert b"".join(map(encode, parts)) == encode(" " + text)


def test_more_languages_than_are_scored_at_once(spark):
    """150 languages, scored in three lots; predictions and scores against plain sums, and null ids and repeated rows among the texts."""
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzéßñçøåäö"
    rows = []
    for k in range(150):
        own = draw.sample(letters, 5)
        rows += [(None if k % 2 else 10 * k + i, " ".join("".join(draw.choices(own, k=draw.randint(2, 5))) for _ in range(12)), f"l{k:03}") for i in range(2)]
    df = spark.createDataFrame(rows + rows[:50], "doc_id long, text string, lang string")
    model = language_id.fit(df)
    assert len(model.languages) == 150 > 2 * language_id.TOGETHER
    numbers, p = language_id.vocabulary_of(model.path).numbers, model.dense(0, 150)
    for r in language_id.predict(df.limit(5), model, ["text"]).collect():
        total = np.array([sum(plain_segmentation(language_id.spelled(w.encode()), numbers, p[:, j]) for w in r.text.split()) for j in range(150)])
        assert r.lang_pred == model.languages[total.argmax()] and r.score == pytest.approx(1 / np.exp(total - total.max()).sum(), rel=1e-6)


def test_repeated_rows_of_a_labelled_id_are_learnt_once(spark):
    rows = [(k, f"text {'vile' if k % 3 == 0 else 'good'} number{k % 7}") for k in range(60)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(60)], "doc_id long, toxic int")
    one = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    many = toxicity.fit(spark.createDataFrame(rows + rows[:20] * 30, "doc_id long, text string"), labels)
    assert one.bias == many.bias and one.index.tolist() == many.index.tolist() and one.weight.tolist() == many.weight.tolist()


def test_the_first_language_model_is_of_bounded_size(spark):
    """Rows that all have the null id and one text are learnt once."""
    docs = spark.createDataFrame([(None, "the same words in every row of this table")] * 500 + [(k, f"other words {k % 5}") for k in range(20)], "doc_id long, text string")
    model, counts = lm.fit(docs)
    assert model.tokens == 500 * 10 + 20 * 4 and counts.count() == 8 + 1 + 2 + 5
    scored = lm.score(docs, model, counts, ["doc_id"]).collect()
    assert len(scored) == 520 and all(np.isfinite(r.score) for r in scored)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.sql(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, rows_plain(got))) == sorted(map(str, rows_plain(want)))


def rows_plain(df):
    """Rows with integers and nulls of one kind."""
    return [tuple(None if pd.isna(v) else int(v) if isinstance(v, (int, float, np.integer, np.floating)) and not isinstance(v, bool) else v for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)]
