"""BibTeX files in blocks against the reader of whole files."""

import random

import pyarrow as pa
import pytest

from stemma.sources import bibtex, bibtex_blocks


def written(draw, n, odd=False):
    out = ["junk } before {\n", '@string{ab = "A " # {B}}\n', "@comment{x}\n", "@preamble{\"\\newcommand{x}\"}\n"]
    for k in range(n):
        value = draw.choice(["{plain}", "{two\nlines {and\n{deep} braces}}", '"quoted {with} @article{inside}"', "ab # {end}", "12", r"{escaped \} and \{ signs}", "{\n\n" + "{a}\n" * draw.randint(0, 12) + "}"])
        out.append(f"@{draw.choice(['article', 'Misc', 'BOOK'])}{{k{k},\n  title = {value},\n  year = {draw.choice(['1900', '{19 00}'])}{draw.choice([',', ''])}\n}}\n{draw.choice(['', 'between: }', '@comment{more}'])}\n")
        if draw.random() < 0.1:
            out.append(f"@string{{ab = {{new {k}}}}}\n")
    if odd:
        out.insert(n // 2, "@misc(round, title = {in } # {parentheses})\n")
    return "".join(out)


def got(df):
    return sorted((r.filename, r.entry_pos, r.bibkey, r.entrytype, tuple(sorted(r.fields.items()))) for r in df.collect())


def test_blocks_are_as_whole_files(spark, tmp_path):
    """Blocks of fewer bytes than an entry, some of one file, some with no border at all; a file that has to be read whole, and small ones."""
    draw = random.Random(3)
    texts = {"a.bib": written(draw, 60), "b.bib": written(draw, 25, odd=True), "c.bib": "", "d.bib": "no entries", "e.bib": "@misc{long, note = {" + "{x\n" * 20 + "y}" * 20 + "}}\n@misc{z,}"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    want = got(bibtex.read(spark, f"file://{tmp_path}/*.bib"))
    for block in (40, 300, 1 << 20):
        assert got(bibtex_blocks.read(spark, f"file://{tmp_path}/*.bib", block=block)) == want
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "300"


@pytest.mark.parametrize("text", ["@misc{a, title = {x}", "@misc{a, title = {x}}}\n@", "@misc{a, title {x}}"])
def test_syntax_problems_raise(spark, tmp_path, text):
    (tmp_path / "a.bib").write_text("@misc{ok, note = {fine}}\n" * 20 + text)
    with pytest.raises(Exception, match="line"):
        bibtex_blocks.read(spark, f"file://{tmp_path}/a.bib", block=100).collect()


def test_answers_of_a_block():
    """For every depth that comes in, what a plain walk over the block says."""
    draw = random.Random(8)
    for _ in range(300):
        text = "".join(draw.choice(["{", "}", "}", "x", "@misc{k, ", "@comment ", "\\}", "\n"]) for _ in range(draw.randint(0, 40)))
        out, reaches, raised = bibtex_blocks.answers(text)
        for d in range(bibtex_blocks.DEPTHS + 1):
            depth, first, _ = bibtex_blocks.ends_of(text, 0, d)
            assert (out[d], reaches[d]) == (depth, d == 0 or first >= 0)
        deep, first, _ = bibtex_blocks.ends_of(text, 0, 1000)
        assert first < 0 and deep == 1000 + raised if raised is not None else True


def test_entries_leave_a_task_some_at_a_time():
    """The entries of a batch of texts and those of a long text come in parts, before the rest is read."""
    texts = ["".join(f"@misc{{k{k},\n  title = {{of {t}}}\n}}\n" for k in range(n)) for t, n in enumerate((2_500, 3, 0, 1_001))] + ["@misc{broken"]
    batch = pa.record_batch([pa.array(["d/a.bib"] * 5), pa.array(range(5)), pa.array(texts), pa.array([None] * 5, pa.string())], ["path", "owner", "text", "given"])
    out = bibtex_blocks.entry_batches(iter([batch]), "utf-8")
    parts = [next(out) for _ in range(6)]
    assert [p.num_rows for p in parts] == [1000, 1000, 500, 3, 1000, 1]
    rows = [r for p in parts for r in p.to_pylist()]
    assert [(r["owner"], r["place"], r["bibkey"]) for r in rows] == [(t, k, f"k{k}") for t, n in enumerate((2_500, 3, 0, 1_001)) for k in range(n)]
    assert dict(rows[2_500]["fields"]) == {"title": "of 1"} and rows[0]["filename"] == "a.bib"
    with pytest.raises(bibtex.SyntaxProblem):
        next(out)


def test_small_blocks_share_tasks(spark, tmp_path):
    (tmp_path / "a.bib").write_text("@misc{k, note = {fine}}\n" * 1_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        lines = bibtex_blocks.lines_of(spark, f"file://{tmp_path}/a.bib", 100)
        assert lines.select("start").distinct().count() > 100 and lines.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
