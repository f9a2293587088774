"""Filings, tables, markdown and chunks, against loops written from the rules."""

import collections
import random
import re

import pytest

from filingloom import sources
from filingloom.functions import sanitize_markup
from filingloom.operators import documents, embedding, exchange, failures, forms, markdown, markup, metadata, periodic, report, tables
from filingloom.plans import queries
from pyspark.sql import functions as F

XML = """<DOCUMENT><DOCUMENT-NAME ACODE="1">[기재정정] Rep</DOCUMENT-NAME><COMPANY-NAME AREGCIK="9">(주) A&B</COMPANY-NAME>
<SUMMARY><EXTRACTION ACODE="E" AFEATURE="F">v</EXTRACTION></SUMMARY><BODY><SECTION-1><TITLE ATOC="Y" AASSOCNOTE="L0">One</TITLE><P>first</P>
<TABLE><TR><TD ROWSPAN="2">Sum</TD><TD>x</TD><TE ACODE="X">1,000</TE></TR><TR><TD>y</TD><TU AUNITVALUE="20200102">day</TU></TR></TABLE>
<SECTION-2><TITLE ATOC="Y">Two</TITLE><SPAN>odd</SPAN><TABLE><TR><TD>only</TD></TR></TABLE></SECTION-2></SECTION-1></BODY></DOCUMENT>"""


def filings(spark, *texts):
    return spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(texts)], "rcept_no string, markup string")


def test_pipeline_document(spark):
    clean = filings(spark, XML).withColumn("markup", sanitize_markup(F.col("markup")))
    blocks = markup.filing_blocks(clean, "pipeline")
    grid = tables.gridded(blocks, "shared")
    got = [(r.label, r.tag, r.value, r.value_type, r.section_path) for r in tables.table_fields(grid).orderBy("block_no", "row").collect()]
    assert got == [("Sum / x", "TE", "1000", "number", ["One"]), ("Sum / y", "TU", "2020-01-02", "date", ["One"])]
    meta = metadata.document_meta(documents.document_header(blocks))
    m = meta.first()
    assert (m.is_correction, m.document_name_clean, m.company_name_clean, m.company_regcik) == (True, "Rep", "A&B", "9")
    text = documents.to_markdown(meta, grid).first().markdown
    assert text == "# [기재정정] Rep\n\n> ⚠️ 본 문서는 [기재정정] 정정공시입니다.\n\n**제출인/회사명:** (주) A&B\n\n## One\n\nfirst\n\n| Sum | x | 1,000 |\n| --- | --- | --- |\n|  | y | day |\n\n### Two\n\nodd\n\n> only"
    assert [r.value for r in documents.summary_items(blocks).collect()] == ["v"]
    counts = report.document_counts(blocks, tables.table_fields(grid)).first()
    assert (counts.n_sections, counts.n_paragraphs, counts.n_fields) == (2, 2, 2)


def test_merged_header(spark):
    xml = "<DOCUMENT><BODY><TABLE><TR><TH ROWSPAN='2'>a</TH><TH COLSPAN='2'>b</TH></TR><TR><TH>c</TH><TH>d|</TH></TR><TR><TD>r</TD><TE>1</TE><TE>2</TE></TR><TR><TD> </TD></TR></TABLE></BODY></DOCUMENT>"
    grid = tables.gridded(markup.filing_blocks(filings(spark, xml), "pipeline"), "shared")
    assert grid.select(tables.table_text("shared").alias("text")).first().text == "| a | b c | b d\\| |\n| --- | --- | --- |\n| r | 1 | 2 |"


def test_toc_and_periodic(spark):
    sections = documents.toc_sections(markup.markup_events(filings(spark, XML))).orderBy("section_no").collect()
    assert [(s.section_id, s.title) for s in sections] == [("L0", "One"), ("", "Two")]
    assert sections[0].text == "One first Sum x 1,000 y day" and sections[1].text == "Two odd only"
    blocks = markup.filing_blocks(filings(spark, XML), "periodic")
    texts = documents.periodic_texts(tables.gridded(blocks, "repeat"))
    got = documents.render_document(documents.document_header(blocks), texts).first().markdown
    assert "\n## One\nfirst\n\n| Sum | x | 1,000 |\n| --- | --- | --- |\n| Sum | y | day |\n\n\n### Two\n\n| only |\n| --- |\n" in got + "\n"


def test_spans_bad_and_broken(spark):
    bad = "<html><title>A/B</title><table><tr><td rowspan='x'>1</td></tr></table></html>"
    two = "<html><title>A/B</title><table><tr><td rowspan=2>k</td><td>v</td></tr><tr><td>w<td></tr></table><table><tr><td>2. S<b> t</b></td><td>z</td></tr></table>"
    blocks = markup.filing_blocks(filings(spark, bad, two, "", "<<<>>> &"), "exchange")
    grid = tables.gridded(blocks, "origin")
    assert [r.rcept_no for r in grid.where("error is not null").collect()] == ["r0"]
    rows = exchange.carry_section(tables.exchange_rows(grid))
    got = exchange.collect_sections(rows).orderBy("rcept_no", "section_no").collect()
    assert [(r.section, r.lines) for r in got] == [("기본사항", ["- k: v", "- w"]), ("2. S t", ["- z"])]
    assert exchange.exchange_titles(blocks).count() == 4
    shared = tables.expand_spans(markup.filing_blocks(filings(spark, "<DOCUMENT><BODY><TABLE><TR><TD COLSPAN='x'>1</TD></TR></TABLE></BODY></DOCUMENT>"), "pipeline"), "shared")
    assert shared.count() == 1


def plain_blocks(text):
    """Runs of lines, straight from the rules."""
    heading, table, item = re.compile(r"^(#{1,6})\s+(.*)$"), re.compile(r"^\s*\|.*\|\s*$"), re.compile(r"^\s*(?:[-*]\s+|\d+\.\s+)")
    out, stack, kind = [], {}, None
    for line in text.replace("\r\n", "\n").split("\n"):
        bare = line.strip()
        if not bare:
            kind = None
            continue
        path = [stack[k] for k in sorted(stack)]
        if m := heading.match(line):
            out.append(["heading", bare, path])
            stack = {k: v for k, v in stack.items() if k < len(m[1])} | {len(m[1]): m[2].strip()}
            kind = None
            continue
        now = "table" if table.match(line) else "blockquote" if bare[0] == ">" else "list" if item.match(line) else "paragraph"
        if now == "paragraph" and kind == "list" and bare[0] not in "#|>":
            now = "list"
        if now == kind:
            out[-1][1] += "\n" + line
        else:
            out.append([now, line, path])
        kind = now
    return [tuple(map(str, b)) for b in out]


def random_markdown(rnd):
    kinds = ["# t{}", "## u{}", "### v{}", "|a|{}|", "|---|---|", "> q{}", "- i{}", "1. n{}", "plain {}", "#x{}", "  | half {}", "", "", "long sentence {}. " * 70, " - in {}", "|" + "x" * 60 + "|{}|"]
    return "\n".join(rnd.choice(kinds).replace("{}", str(i)) for i in range(rnd.randint(0, 40)))


def test_markdown_blocks_and_chunks(spark):
    rnd = random.Random(3)
    texts = [random_markdown(rnd) for _ in range(60)] + ["", "|a|\n" + "\n".join("|" + "y" * 90 + "|" for _ in range(40))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in markdown.markdown_blocks(docs).orderBy("doc_id", "block_no").collect():
        got.setdefault(r.doc_id, []).append((r.type, r.text, str(r.heading_path)))
    for i, t in enumerate(texts):
        assert got.get(i, []) == plain_blocks(t), t
    chunks = markdown.chunk_markdown(docs).orderBy("doc_id", "chunk_index").collect()
    by = {}
    for c in chunks:
        by.setdefault(c.doc_id, []).append(c)
    assert len({c.chunk_id for c in chunks}) == len(chunks)
    for i, t in enumerate(texts):
        mine = by.get(i, [])
        assert [c.chunk_index for c in mine] == list(range(len(mine)))
        assert all(c.char_count <= 1300 or not c.has_table and c.char_count <= 1150 for c in mine)
        for c, after in zip(mine, mine[1:]):  # one trailing heading moves on to the next chunk, earlier ones stay
            last = c.text.split("\n\n")[-1]
            assert not re.fullmatch(r"#{1,6}\s.*", last) or re.match(r"#{1,6}\s", after.text)
        whole = "\n".join(c.text for c in mine)
        assert all(w in whole for w in re.findall(r"[tuvqin]\d+", t))


def test_packing_rules():

    assert markdown.packed(["paragraph", "paragraph"], [700, 400], 800, 1000) == [0, 0]  # short of the minimum: may run over
    assert markdown.packed(["paragraph", "heading", "paragraph"], [900, 20, 500], 800, 1000) == [0, 1, 1]  # the heading moves on
    assert markdown.packed(["heading", "table"], [20, 2000], 800, 1000) == [0, 0]
    assert markdown.packed(["table", "paragraph"], [2000, 5], 800, 1000) == [0, 1]
    assert markdown.packed(["table", "paragraph"], [1200, 5], 800, 1000) == [0, 1]
    assert markdown.packed([], [], 800, 1000) == []


def test_table_and_overlap_splits(spark):
    rows = ["|h|", "|---|"] + ["|" + "z" * n + "|" for n in (40, 50, 200, 10, 90)]
    b = spark.createDataFrame([(1, "table", "\n".join(rows), []), (2, "table", "|h|\n|---|", [])], "doc_id long, type string, text string, heading_path array<string>")
    parts = markdown.split_table(b, 120).orderBy("doc_id", "part").collect()
    assert [len(p.text.split("\n")) - 2 for p in parts] == [2, 1, 2, 0] and all(p.text.startswith("|h|\n|---|") for p in parts)
    assert [p.n_chars for p in markdown.split_table(b, 120, "periodic").where("doc_id = 1").orderBy("part").collect()] == [102, 210, 112]
    assert markdown.split_table(b, 120, "periodic").where("doc_id = 2").count() == 0
    assert periodic.flushes([True, False, True, False], [5, 5, 3, 20], 10) == [0, 0, 1, 1]
    assert periodic.flushes([True, False, False], [20, 3, 3], 10) == [0, 1, 1]


def plain_texts(sentences, most):
    """Sentences packed one after the other; what is too long is cut."""
    out, cur = [], ""
    for s in (x for x in sentences if x.strip()):
        both = (cur + " " + s).strip() if cur else s
        if cur and len(both) > most:
            out, cur = [*out, cur], s
        else:
            cur = both
        while len(cur) > most:
            out, cur = [*out, cur[:most]], cur[most:]
    return out + [cur] * bool(cur)


def plain_overlap(sentences, most, overlap):
    out, cur = [], ""
    for s in sentences:
        if len(cur) + len(s) + 1 <= most:
            cur = (cur + " " + s).strip()
            continue
        out += [cur] * bool(cur)
        cur = (cur[-overlap:] + " " + s).strip()
        while len(cur) > most:
            out, cur = [*out, cur[:most]], cur[most - overlap :]
    return out + [cur] * bool(cur)


def test_texts_split_as_by_loops(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.choice([1, 2, 5, 9, 40])))
    texts = ["".join(word() + rnd.choice([" ", " ", " ", ". ", ".  ", "\n", " \n ", "!\n", ": ", "다 "]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    texts += ["  " + "x" * 90 + "  y. z", "a. " * 50, "a" * 25, "q" * 60 + " " * 40 + "r. s", ". ".join("w" * n for n in range(1, 60)), " lead. " + "b" * 30]
    df = spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string")
    for most in (20, 50):
        got = {}
        for r in markdown.split_text(df, most).orderBy("doc_id", "part").collect():
            got.setdefault(r.doc_id, []).append(r.text)
            assert r.part == len(got[r.doc_id])
        for i, t in enumerate(texts):
            want = [t] if len(t) <= most else plain_texts(re.split(r"(?<=[.!?다요음함])\s+|\n", t), most)
            assert got.get(i, []) == want, t
        assert got[len(texts)] == [""]
        got = {}
        for r in periodic.split_overlap(df, most, 7).orderBy("doc_id", "part").collect():
            got.setdefault(r.doc_id, []).append(r.text)
        for i, t in enumerate(texts):
            want = [t] if len(t) <= most else plain_overlap(re.split(r"(?<=[.?!다음:])\s+", t), most, 7)
            assert got.get(i, []) == want, t


def test_failed_rows_are_kept_or_raised(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "bad")], "doc_id long, text string")

    def helper(text):
        if text == "bad":
            raise ValueError("no")
        return [{"text": text}]

    for how in ("warn", "raise"):
        made = df.select("doc_id", markdown.guarded(helper, how, "array<struct<text:string>>")("text").alias("_made"))
        rows = markdown.unfolded(made, "_made", ["text"], how)
        if how == "warn":
            assert sorted((r.doc_id, r.text, r.error) for r in rows.collect()) == [(1, "ab", None), (2, None, "ValueError: no")]
        else:
            with pytest.raises(Exception, match="no"):
                rows.collect()


def paint(rows, policy, n_cols=0):
    """A grid painted cell by cell, straight from the rules of each family."""
    grid, out, n = {}, [], 0
    last = len(rows)
    width = max([n_cols, *(sum(w for _, w in r) for r in rows)], default=0)
    owed = {}
    for r, cells in enumerate(rows):
        col = 0
        if policy == "repeat":
            cells, line = list(cells), {}
            while col < width:
                if owed.get(col, (0, 0))[0]:
                    left, who = owed[col]
                    line[col], owed[col] = who, (left - 1, who)
                    col += 1
                elif cells:
                    down, right = cells.pop(0)
                    for c in range(col, min(col + right, width)):
                        line[c] = n
                        if down > 1:
                            owed[c] = (down - 1, n)
                    n, col = n + 1, col + right
                else:
                    break
            n += len(cells)
            out += [(r, c, line.get(c, -1)) for c in range(width)]
            continue
        for down, right in cells:
            while (r, col) in grid:
                col += 1
            for c in range(col, col + right):
                if policy == "shared":
                    if down > 1:
                        for k in [k for k in grid if k[1] == c and k[0] > r]:
                            del grid[k]
                    for i in range(max(1, down)):
                        if r + i < last:
                            grid[r + i, c] = n
                else:
                    for i in range(down):
                        grid[r + i, c] = n if (i, c) == (0, col) else -1
            n, col = n + 1, col + right
    if policy == "shared":
        for r in range(last):
            used = [c for k, c in grid if k == r]
            out += [(r, c, grid.get((r, c), -1)) for c in range(max(used, default=-1) + 1)]
    elif policy == "origin":
        out = sorted((r, c, v) for (r, c), v in grid.items())
    return out


def test_spans_as_painted(spark):
    rnd = random.Random(2)
    made = [[[(rnd.choice([1, 1, 1, 2, 3, 0]), rnd.choice([1, 1, 1, 2, 3])) for _ in range(rnd.randint(1, 5))] for _ in range(rnd.randint(1, 6))] for _ in range(250)]
    made += [[[(1, 1)] * 3] * 3, [[(1, 1)] * 2, [(1, 1)]], [[(5, 2)]], [[(1, 4)], [(2, 1), (2, 1)], [(1, 3)]]]
    data = []
    for i, rows in enumerate(made):
        cells = [{"row": r, "at": at, "tag": "TD", "text": "t", "acode": None, "aunit": None, "aunitvalue": None, "rowspan": None if d == 1 else str(d), "colspan": None if w == 1 else str(w)} for r, row in enumerate(rows) for at, (d, w) in enumerate(row)]
        data.append((str(i), 1, "table", i % 4, cells))
    df = spark.createDataFrame(data, f"rcept_no string, block_no int, type string, n_cols int, cells array<{markup.CELL}>")
    for policy in ("shared", "repeat", "origin"):
        got = {}
        for r in tables.expand_spans(df, policy).collect():
            assert r.error is None
            if r.row is not None:  # a table without places keeps one empty row
                got.setdefault(int(r.rcept_no), []).append((r.row, r.col, r.cell_no))
        for i, rows in enumerate(made):
            assert sorted(got.get(i, [])) == sorted(paint(rows, policy, i % 4)), (policy, rows)


def test_declared_encodings(spark):
    xml = "<?xml version='1.0' encoding='{}'?><DOCUMENT><BODY><P>한국 A&B</P></BODY></DOCUMENT>"
    files = [xml.format("euc-kr").encode("euc-kr"), xml.format("utf-8").encode(), xml.format("nonsense").encode("euc-kr"), xml.format("utf-16").encode("euc-kr")]
    df = spark.createDataFrame([(str(i), bytearray(f)) for i, f in enumerate(files)], "rcept_no string, content binary")
    got = [r.text for r in markup.filing_blocks(df, "pipeline", sanitize=True).where("type = 'paragraph'").orderBy("rcept_no").collect()]
    assert got[:2] == ["한국 A&B"] * 2 and all(t.endswith("A&B") for t in got)


def test_table_of_many_rows(spark):
    rows = "\n".join(["|h|", "|---|", *("|" + "r" * (i % 50) + "|" for i in range(100_000))])
    b = spark.createDataFrame([(1, 1, "table", rows, [])], "doc_id long, block_no int, type string, text string, heading_path array<string>")
    parts = markdown.split_table(b, 1000).collect()
    assert sum(len(p.text.split("\n")) - 2 for p in parts) == 100_000 and all(len(p.text) <= 1000 for p in parts)


def test_periodic_chunks(spark):
    blocks = spark.createDataFrame([("r", 1, "text", ["A"], "x" * 1000), ("r", 2, "text", ["A"], "y" * 500), ("r", 3, "text", ["A"], "z"), ("r", 4, "table", ["A"], "|t|"), ("r", 5, "text", ["B"], "w"), ("r", 6, "table", ["B"], "|h|\n|-|" + "\n|" + "q" * 2990 + "|" + "\n|" + "q" * 300 + "|")], "rcept_no string, block_no int, type string, section_path array<string>, text string")
    meta = spark.createDataFrame([("r", "c")], "rcept_no string, corp_name string")
    got = periodic.chunk_periodic(blocks, meta).orderBy("chunk_index", "chunk_id").collect()
    assert [(c.chunk_id, c.chunk_type, c.section) for c in got] == [("r_0001", "text", "A"), ("r_0002", "text", "A"), ("r_0003", "text", "A"), ("r_0004", "table", "A"), ("r_0005", "text", "B"), ("r_0006_p1", "table", "B"), ("r_0006_p2", "table", "B")]


def test_manifest_lines(spark):
    lines = ['{"rcept_no": "1", "corp_name": "a"}', "", '{"rcept_no": "1", "corp_name": "b"}', '{"corp_name": "no key"}', "{bad"]
    df = spark.createDataFrame(list(enumerate(lines)), "position long, value string")
    assert [(r.rcept_no, r.corp_name) for r in sources.parse_manifest(df, on_bad="skip").collect()] == [("1", "b")]
    try:
        sources.parse_manifest(df).collect()
        raise AssertionError("a bad line must fail")
    except Exception as e:
        assert "bad manifest line" in str(e)


def test_files_round_trip(spark, tmp_path):
    raw = tmp_path / "raw" / "a"
    raw.mkdir(parents=True)
    (raw / "2020.xml").write_text("﻿" + XML)
    (raw / "2021.xml").write_bytes(b"<DOCUMENT>\xff")
    (raw / "x.md").write_text("# t\n\nbody")
    (tmp_path / "m.jsonl").write_text('{"rcept_no": "2020", "corp_name": "a"}\n\n{"rcept_no": "2020", "corp_name": "b"}\n')
    assert [r.corp_name for r in sources.read_manifest(spark, str(tmp_path / "m.jsonl")).collect()] == ["b"]
    assert sources.read_manifest(spark, str(tmp_path / "none"), missing_ok=True).count() == 0
    scanned = sources.scan_filings(spark, str(tmp_path / "raw"))
    assert sorted(r.rcept_no for r in scanned.collect()) == ["2020", "2021"]
    assert [r.rcept_no for r in sources.scan_filings(spark, str(tmp_path / "raw"), limit=1).collect()] == ["2020"]
    assert markup.filing_blocks(scanned, "pipeline").where("type = 'table'").count() == 2
    assert sources.scan_markdown(spark, str(tmp_path / "raw")).first().doc_id == "x"
    c = spark.createDataFrame([("r_0001", "r", 1, "t"), ("r_0002", "r", 2, None)], "chunk_id string, rcept_no string, chunk_index int, text string")
    sources.write_chunks(c, str(tmp_path / "chunks"))
    assert sources.read_chunks(spark, str(tmp_path / "chunks"), "*.json").count() == 2
    log = report.run_log(spark.createDataFrame([("r", True, None), ("s", False, None), ("t", True, "bad")], "rcept_no string, manifest_matched boolean, error string"), c, c)
    s = report.run_summary(log).first()
    assert (s.total, s.ok, s.ok_no_manifest, s.error, s.empty, s.total_chunks) == (3, 1, 1, 1, 1, 2)
    sources.write_run_report(log, report.run_summary(log), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "failed")).count() == 1


def test_embedding_resumes(spark, tmp_path):
    chunks = spark.createDataFrame([("a", "x", ""), ("b", "", "fails"), (None, "y", ""), ("d", "", ""), ("e", "z", "")], "chunk_id string, text string, embedding_text string")

    def embedder(texts):
        if "fails" in texts:
            raise ValueError("no")
        return [[float(len(t))] for t in texts]

    out = embedding.embed_chunks(chunks, embedder, max_retries=2, wait=lambda s: None)
    sources.append_embeddings(metadata.keep_metadata(out.where("outcome = 'done'"), "embedding"), str(tmp_path / "store"))
    assert embedding.embedding_summary(out).first().asDict() == {"total": 5, "done": 2, "skipped": 2, "failed": 1}
    again = metadata.resume_candidates(chunks, spark.read.parquet(str(tmp_path / "store")))
    assert sorted(str(r.chunk_id) for r in again.collect()) == ["None", "b", "d"]


def test_staged_tables(spark):
    df = spark.range(5)
    kept = sources.staged(df)
    assert kept.count() == 5 and sources.spread(df, "id").rdd.getNumPartitions() >= 4
    sources.drop_staged(spark)
    assert sources.staged(df).count() == 5

    class Far:
        """A session on a cluster that names no folder."""

        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        sources.shared_dir(Far)


def test_bad_manifest_lines(spark):
    lines = ['{"rcept_no": "1"}', "", "  ", "{bad", "[1]", '{"rcept_no": "2"}']
    r = sources.bad_lines(spark.createDataFrame([(x,) for x in lines], "value string")).first()
    assert r.lines == 4 and r.bad >= 1


BAD = "<DOCUMENT><BODY><P>p</P><TABLE><TR><TD COLSPAN='x'>1</TD></TR></TABLE><P>q</P></BODY></DOCUMENT>"


def test_failed_documents_are_parted(spark):
    """A failed table takes its whole filing out, with the first of its errors, in both families; "raise" fails the job."""
    good = "<DOCUMENT><BODY><P>p</P><TABLE><TR><TD ROWSPAN='2'>a</TD><TD>b</TD></TR><TR><TD>c</TD></TR></TABLE></BODY></DOCUMENT>"
    blocks = sources.staged(markup.filing_blocks(filings(spark, good, BAD, "", "<DOCUMENT><BO"), "periodic"))
    docs = spark.createDataFrame([(f"r{i}", i != 2) for i in range(5)], "rcept_no string, manifest_matched boolean")
    meta = docs.select("rcept_no")
    texts = documents.periodic_texts(tables.gridded(blocks, "repeat"))
    chunks = periodic.chunk_periodic(texts, meta, "warn")
    assert sorted((c.rcept_no, c.chunk_id, c.error is None) for c in chunks.collect()) == [("r0", "r0_0001", True), ("r0", "r0_0002", True), ("r1", None, False)]
    log = {r.rcept_no: r for r in report.run_log(docs, texts, chunks).collect()}
    assert [(log[f"r{i}"].status, log[f"r{i}"].n_blocks, log[f"r{i}"].n_chunks, log[f"r{i}"].empty_blocks) for i in range(5)] == [("ok", 2, 2, False), ("error", 0, 0, False), ("ok_no_manifest", 0, 0, True), ("ok", 0, 0, True), ("ok", 0, 0, True)]
    assert log["r1"].error == "ValueError: invalid literal for int() with base 10: 'x'"
    with pytest.raises(Exception, match="invalid literal"):
        periodic.chunk_periodic(texts, meta).collect()
    html = "<html><title>A/B</title><table><tr><td{}>k</td><td>v</td></tr></table></html>"
    sections, bad = exchange.exchange_sections(tables.gridded(markup.filing_blocks(filings(spark, html.format(""), html.format(" rowspan='1.5'")), "exchange"), "origin"))
    assert [r.rcept_no for r in sections.collect()] == ["r0"] and [r.rcept_no for r in bad.collect()] == ["r1"]
    named = meta.select("rcept_no", *(F.lit("x").alias(c) for c in ("corp_name", "report_nm", "rcept_dt")))
    both = sections.withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)
    assert sorted((c.rcept_no, c.chunk_id) for c in exchange.chunk_exchange(both, named, "warn").collect()) == [("r0", "r0_0001"), ("r1", None)]
    with pytest.raises(Exception, match="r1: ValueError"):
        exchange.chunk_exchange(both, named).collect()


def test_failure_while_chunking(spark):
    """A document that fails within a job leaves its key and error alone; the others keep their chunks."""
    rows = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("b", 2, None), ("c", 1, "read")], "rcept_no string, block_no int, error string")

    def job(good):
        error = F.when((F.col("rcept_no") == "b") & (F.col("block_no") == 2), "split")
        return good.select("rcept_no", F.col("block_no").alias("chunk_index"), F.lit("x").alias("text"), error.alias("error"))

    got = failures.isolated(rows, job, "warn").collect()
    assert sorted((r.rcept_no, r.chunk_index, r.text, r.error) for r in got) == [("a", 1, "x", None), ("b", None, None, "split"), ("c", None, None, "read")]
    with pytest.raises(Exception, match="c: read"):
        failures.isolated(rows, job, "raise").collect()
    docs = spark.createDataFrame([(1, "# a\n\n" + "word. " * 300), (None, "short"), (3, None)], "doc_id long, text string")
    same = [sorted((r.doc_id or 0, r.chunk_index, r.text) for r in markdown.chunk_markdown(docs, on_error=how).collect()) for how in ("warn", "raise")]
    assert same[0] == same[1] and len(same[0]) == 3


def test_errors_of_stages(spark):
    docs = spark.createDataFrame([("a", None), ("b", "own"), ("c", None), ("d", None)], "rcept_no string, error string")
    one = spark.createDataFrame([("a", 2, "later"), ("a", 1, "first"), ("b", 1, "other"), ("d", 1, None)], "rcept_no string, block_no int, error string")
    two = spark.createDataFrame([("a", 1, "chunk"), ("c", 1, "chunk")], "rcept_no string, block_no int, error string")
    out = failures.with_errors(docs, failures.first_errors(one), failures.first_errors(two))
    assert sorted((r.rcept_no, r.error) for r in out.collect()) == [("a", "first"), ("b", "own"), ("c", "chunk"), ("d", None)]
    good, bad = failures.parted(one)
    assert [r.rcept_no for r in good.collect()] == ["d"] and sorted((r.rcept_no, r.error) for r in bad.collect()) == [("a", "first"), ("b", "other")]


def plain_fields(grid, cells):
    """Fields of a table, by a walk over its rows."""
    out, seen = [], set()
    for r, line in enumerate(grid):
        labels = []
        for col, n in enumerate(line):
            if n is None or n < 0:
                continue
            tag, text = cells[n]
            if tag in ("TE", "TU"):
                if n not in seen:
                    out.append((r, col, " / ".join(dict.fromkeys(labels)) or None, text))
                    labels = []
                seen.add(n)
            elif text:
                labels.append(text)
    return out


def plain_pipes(grid, cells):
    """A shared grid as text, by loops."""
    full = [["" if n is None or n < 0 else cells[n][1] for n in line] for line in grid]
    seen, shown = set(), []
    for line in grid:
        shown.append(["" if n is None or n < 0 or n in seen or seen.add(n) else cells[n][1] for n in line])
    first = next((r for r, line in enumerate(grid) if any(n is not None and n >= 0 and cells[n][0] in ("TE", "TU") for n in line)), 0)
    body = [line for line in shown[first:] if any(line)]
    if not body:
        return None
    if not first and len(body) == 1 and len(body[0]) == 1:
        return "> " + body[0][0]
    if first:
        names = [[] for _ in range(max(map(len, grid)))]
        for line in full[:first]:
            for c, t in enumerate(line):
                if t and (not names[c] or names[c][-1] != t):
                    names[c].append(t)
        body = [[" ".join(n) for n in names], *body]
    width = max(map(len, body))
    rows = ["| " + " | ".join(line + [""] * (width - len(line))) + " |" for line in body]
    return "\n".join([rows[0], "| " + " | ".join(["---"] * width) + " |", *rows[1:]])


def test_tables_as_walked(spark):
    """Fields and texts from arrays equal loops over painted grids, with merged, missing, empty and repeated cells."""
    rnd = random.Random(5)
    made = []
    for i in range(250):
        plain = rnd.random() < 0.3
        size = rnd.randint(1, 4)
        made.append([[(1, 1) if plain else (rnd.choice([1, 1, 1, 2, 3]), rnd.choice([1, 1, 2])) for _ in range(size if plain else rnd.randint(1, 4))] for _ in range(rnd.randint(1, 5))])
    data, texts = [], []
    for i, rows in enumerate(made):
        flat = [(rnd.choice(["TD", "TH", "TE", "TU"]), rnd.choice(["", "a", "b", "c", "1", "22"])) for r in rows for _ in r]
        texts.append(flat)
        cells = iter(flat)
        data.append((str(i), 1, "table", ["s"], None, 0, [{"row": r, "at": at, "tag": t, "text": x, "acode": None, "aunit": None, "aunitvalue": None, "rowspan": str(d), "colspan": str(w)} for r, row in enumerate(rows) for at, (d, w) in enumerate(row) for t, x in [next(cells)]], None))
    df = spark.createDataFrame(data, f"rcept_no string, block_no int, type string, section_path array<string>, aclass string, n_cols int, cells array<{markup.CELL}>, error string")
    grids = tables.gridded(df, "shared")
    fields, pipes = {}, {int(r.rcept_no): r.text for r in grids.select("rcept_no", tables.table_text("shared").alias("text")).collect()}
    for r in tables.table_fields(grids).orderBy("row", "col").collect():
        fields.setdefault(int(r.rcept_no), []).append((r.row, r.col, r.label, r.raw_value))
    for i, rows in enumerate(made):
        places = {}
        for r, c, n in paint(rows, "shared"):
            places.setdefault(r, {})[c] = n
        grid = [[places[r].get(c, -1) for c in range(max(places[r]) + 1)] if r in places else [] for r in range(max(places, default=-1) + 1)]
        assert fields.get(i, []) == plain_fields(grid, texts[i]), rows
        assert pipes[i] == plain_pipes(grid, texts[i]), (rows, texts[i])


def test_any_number_of_blocks_streams(spark):
    """Chunks and buffers of a document of many blocks, cut into small batches, equal those of the loops."""
    rnd = random.Random(4)
    n = 60_000
    kinds, sizes = [rnd.choice(["heading", "paragraph", "table", "list"]) for _ in range(n)], [rnd.choice([5, 90, 400, 900, 1500]) for _ in range(n)]
    rows = spark.createDataFrame([(1, i, k, s) for i, (k, s) in enumerate(zip(kinds, sizes))] + [(2, 0, "heading", 3)], "doc_id long, pos int, type string, length int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.doc_id, r.pos): r.chunk_index for r in markdown.pack_chunks(rows).collect()}
        assert [got[1, i] for i in range(n)] == markdown.packed(kinds, sizes, 800, 1000) and got[2, 0] == 0
        paths = [[str(i // 50)] for i in range(3000)]
        types = [rnd.choice(["text", "text", "text", "table"]) for _ in paths]
        lengths = [rnd.choice([10, 300, 900]) for _ in paths]
        b = spark.createDataFrame([("r", i, t, p, chr(97 + i % 26) * k) for i, (t, p, k) in enumerate(zip(types, paths, lengths))], "rcept_no string, block_no int, type string, section_path array<string>, text string")
        out = periodic.buffered(b).orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want: list = []
    open_: list = []
    for i, (t, p, k) in enumerate(zip(types, paths, lengths)):
        if open_ and (t == "table" or paths[open_[-1]] != p or types[i - 1] == "table" or sum(lengths[j] + 1 for j in open_) - 1 > 1400):
            want.append((open_[0], "text", len(open_)))
            open_ = []
        if t == "table":
            want.append((i, "table", 1))
        else:
            open_.append(i)
    if open_:
        want.append((open_[0], "text", len(open_)))
    assert [(r.pos, r.type, r.text.count("\n") + 1) for r in out] == want


def test_scanned_files(spark, tmp_path):
    names = ["a [1]*.xml", "b {x}.xml", "ä b+%20.xml", "z.xml"]
    for n in names:
        (tmp_path / n).write_text(f"<P>{n}</P>")
        (tmp_path / n.replace(".xml", ".md")).write_text(f"# {n}\n\nbody\n")
    first = sources.scan_filings(spark, str(tmp_path), limit=2)
    assert sorted(r.rcept_no for r in first.collect()) == ["a [1]*", "b {x}"]
    assert len(first.inputFiles()) == 2  # the others are never opened
    assert sorted((r.doc_id, r.text) for r in sources.scan_markdown(spark, str(tmp_path)).collect()) == sorted((n[:-4], f"# {n}\n\nbody\n") for n in names)
    assert sources.scan_filings(spark, str(tmp_path), "*.none", limit=3).count() == 0


def test_counts_come_with_the_data(spark, tmp_path):
    lines = spark.createDataFrame([(0, '{"rcept_no": "1"}'), (1, ""), (2, "{bad"), (3, '{"rcept_no": "1", "sector": null}')], "position long, value string")
    rows, seen = sources.counted_manifest(lines, given=True)
    assert seen == sources.bad_lines(lines).first().asDict() == {"lines": 3, "bad": 1}
    assert [(r.rcept_no, sorted(r.given)) for r in rows.collect()] == [("1", ["rcept_no", "sector"])]
    calls = spark.sparkContext.accumulator(0)

    def embedder(texts):
        calls.add(len(texts))
        if "bad" in texts:
            raise ValueError("no")
        return [[1.0]] * len(texts)

    chunks = spark.createDataFrame([(str(i), "bad" if i == 3 else "t") for i in range(8)] + [(None, "t"), ("n", "")], "chunk_id string, text string").coalesce(1)
    done = embedding.embed_and_append(chunks, embedder, str(tmp_path / "store"), max_retries=1, batch=1)
    assert done == {"total": 10, "done": 7, "skipped": 2, "failed": 1} and calls.value == 8  # one job: no text is asked for twice
    assert spark.read.parquet(str(tmp_path / "store")).count() == 7


def test_waves_survive_a_crash(spark, tmp_path):
    chunks = spark.createDataFrame([(str(i), f"t{i}") for i in range(80)] + [(None, "x")], "chunk_id string, text string")
    wave = {r.chunk_id: r.w for r in chunks.select("chunk_id", F.pmod(F.xxhash64("chunk_id"), F.lit(5)).alias("w")).collect()}
    doomed, path = {f"t{k}" for k, w in wave.items() if k and w == 3}, str(tmp_path / "store")

    def crashing(texts):
        if doomed & set(texts):
            raise SystemExit("worker lost")
        return [[1.0]] * len(texts)

    with pytest.raises(Exception):
        embedding.embed_in_waves(chunks, crashing, path, 5)
    kept = {r.chunk_id for r in spark.read.parquet(path).collect()}
    assert kept == {k for k, w in wave.items() if k and w < 3}
    asked = spark.sparkContext.accumulator(0)

    def counting(texts):
        asked.add(len(texts))
        return [[2.0]] * len(texts)

    done = embedding.embed_in_waves(chunks, counting, path, 5)
    assert asked.value == done["done"] == 80 - len(kept) and done["skipped"] == 1
    assert spark.read.parquet(path).select("chunk_id").distinct().count() == spark.read.parquet(path).count() == 80


def test_bucketed_store_is_not_shuffled(spark, tmp_path):
    ids = spark.range(500).select(F.col("id").cast("string").alias("chunk_id"))
    for some in (ids.where("chunk_id % 3 = 0"), ids.where("chunk_id % 7 = 0")):
        sources.append_store(some, "bucketed_store", str(tmp_path / "store"), 4)
    left = metadata.resume_candidates(ids.withColumn("text", F.lit("t")), spark.table("bucketed_store"))
    assert {int(r.chunk_id) for r in left.collect()} == {i for i in range(500) if i % 3 and i % 7}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = metadata.resume_candidates(ids, spark.table("bucketed_store"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table bucketed_store")
    store = plan[: plan.index("bucketed_store")].splitlines()[-8:]
    assert plan.count("Exchange hashpartitioning") == 1 and not any("Exchange" in line for line in store if "store" in line)


def test_families_are_rewritten(spark, tmp_path):
    rows = lambda family, n: spark.range(n).select(F.lit(family).alias("family"), "id")
    sources.write_families(rows("a", 5).union(rows("b", 7)), str(tmp_path))
    sources.write_families(rows("b", 2), str(tmp_path))
    assert {(r.family, r["count"]) for r in spark.read.parquet(str(tmp_path)).groupBy("family").count().collect()} == {("a", 5), ("b", 2)}


def test_both_readers_make_the_same_tree():
    """The parser for well-formed markup against the tolerant reader, on random markup, whole and damaged."""
    rnd = random.Random(6)
    flat = lambda n: [k if isinstance(k, str) else (k.tag, k.attrs, flat(k)) for k in n.kids]
    used = collections.Counter()

    def made(depth=0):
        out = ""
        for _ in range(rnd.randint(0, 4)):
            kind = rnd.random()
            if kind < 0.4 or depth > 4:
                out += rnd.choice(["text", " ", "\n", "a &amp; b", "&lt;x&gt;", "한국 é", "&quot;", ">", "]]", "tab\there", "&nbsp;", "&", "&#65;", "<!-- c -->", "<![CDATA[d]]>", "<?pi x?>", "\r\n"] + ["plain"] * 20)
            else:
                tag = rnd.choice(["P", "td", "Table", "SECTION-1", "br", "script", "a:b", "_x", "é"] + ["TD", "TR"] * 6)
                attrs = "".join(f' {rnd.choice(["A", "b", "rowSpan"])}{i}={chr(34) + rnd.choice(["x", "&amp;&lt;", "1 2", "it" + chr(39) + "s", ""]) + chr(34)}' for i in range(rnd.randint(0, 2)))
                out += f"<{tag}{attrs}/>" if rnd.random() < 0.2 else f"<{tag}{attrs}>{made(depth + 1)}</{tag}>"
        return out

    for _ in range(4000):
        text = rnd.choice(["", "<?xml version='1.0' encoding='euc-kr'?>"]) + f"<DOCUMENT>{made()}{made()}</DOCUMENT>"
        if rnd.random() < 0.3:
            at = rnd.randrange(len(text))
            text = text[:at] + rnd.choice(["", "<", ">", "&", "/", '"', "x"]) + text[at + 1 :]
        for html in (False, True):
            fast, reader = markup.well_formed(text, html), markup.Reader(html)
            used[fast is not None] += 1
            if fast is not None:
                reader.feed(text)
                reader.close()
                assert flat(fast) == flat(reader.root), text
    assert used[True] > 1000 and used[False] > 1000
    long = "<DOCUMENT><P>" + "long text é " * 20_000 + "</P></DOCUMENT>"
    assert len(markup.well_formed(long, False).kids[0].kids[0].kids) == 1


def test_page_titles_read_ampersands_alone(spark, tmp_path):
    titles = ["a &amp; b", "cut &amp", "&quot;q&quot; &lt", "&amp;quot; x", "R&D & more"]
    rows = [(i, f"<html><head><title>{t}</title></head><body><h1>x &quot;</h1></body></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: (r.company_name, r.report_name) for r in queries.page_titles(spark, str(tmp_path)).collect()}
    assert got == {str(i): ("", t.replace("&amp;", "&")) for i, t in enumerate(titles)}


def test_bare_ampersands_take_the_fast_parser():
    for text in ("<P a='x&amp;y'>A&B R&D & &amp;amp; &lt;</P>", "<P>a&</P>", "<P>&;&zz;</P>"):
        reader = markup.Reader(False)
        reader.feed(text)
        reader.close()
        fast = markup.well_formed(text, False)
        assert fast is not None and fast.kids[0].texts() == reader.root.kids[0].texts() and fast.kids[0].attrs == reader.root.kids[0].attrs
    assert markup.well_formed("<P>&copy 1 &nbsp;</P>", False) is None


def test_grids_read_their_input_once(spark, tmp_path):
    markup.filing_blocks(filings(spark, XML), "pipeline").write.parquet(str(tmp_path / "blocks"))
    plan = tables.gridded(spark.read.parquet(str(tmp_path / "blocks")), "shared")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_long_texts_go_in_small_batches(spark):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("chunk_id"), F.repeat(F.lit("long text. "), 200).alias("text")).coalesce(1)
    sizes = embedding.embed_chunks(rows, lambda texts: [[float(len(texts))]] * len(texts), batch=100_000)
    assert max(r.embedding[0] for r in sizes.select("embedding").collect()) <= sources.BATCH_ROWS


def test_blocks_need_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "# a\n\n- x\nplain\n> q\n## b\nt"), (2, None), (None, "p")], "doc_id long, text string")
    blocks = markdown.markdown_blocks(docs)
    assert "Exchange" not in blocks._jdf.queryExecution().executedPlan().toString()
    got = [(r.doc_id, r.block_no, r.type, r.text, r.level, r.heading_path) for r in blocks.collect()]
    assert got == [(1, 1, "heading", "# a", 1, []), (1, 2, "list", "- x\nplain", None, ["a"]), (1, 3, "blockquote", "> q", None, ["a"]), (1, 4, "heading", "## b", 2, ["a"]), (1, 5, "paragraph", "t", None, ["a", "b"]), (None, 1, "paragraph", "p", None, [])]


def test_blocks_are_made_from_elements_in_c():
    """Blocks of the elements in C against those of the tolerant reader's nodes."""
    inner = "<TABLE ROWSPAN='3'><COLGROUP><COL/><COL/></COLGROUP><TR><TD>a<B>b</B>c</TD><TE ACODE='X' RowSpan='2'> v </TE></TR><TR/></TABLE>"
    texts = [XML, f"<DOCUMENT><BODY>x<P>p<I>q</I>r</P>{inner}<TABLE-GROUP ACLASS='k'>{inner}</TABLE-GROUP><TABLE><TR><TD>{inner}</TD></TR></TABLE></BODY></DOCUMENT>", "<html><P class='a xforms_title'>t<B>u</B></P></html>", "<a/>", "<title/>"]
    for text in texts:
        for style, walker in markup.WALKERS.items():
            root = markup.elements(text, style == "exchange")
            assert style == "exchange" or root.__class__ is markup.Element  # HTML reads some elements in a way of its own
            assert walker(root) == walker(markup.tolerant(text, style == "exchange")), (style, text)


def test_texts_of_tables_are_made_once(spark, tmp_path):
    markup.filing_blocks(filings(spark, XML), "periodic").write.parquet(str(tmp_path / "blocks"))
    blocks = spark.read.parquet(str(tmp_path / "blocks"))
    made = [documents.periodic_texts(tables.gridded(blocks, "repeat")), documents.to_markdown(metadata.document_meta(documents.document_header(blocks)), tables.gridded(blocks, "shared"))]
    for df in made:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_replace" in line]


def test_periodic_buffers_are_made_once(spark):
    blocks = spark.createDataFrame([("a", 1, "text", ["S"], "x" * 900), ("a", 2, "text", ["S"], None), ("a", 3, "table", ["S"], "|" * 1500), ("a", 4, "text", ["S"], ""), ("a", 5, "table", ["S"], "t"), ("a", 6, "text", ["T"], "y"), ("b", 1, "text", None, "z")], "rcept_no string, block_no int, type string, section_path array<string>, text string")
    chunks = periodic.chunk_periodic(blocks, spark.createDataFrame([("a",), ("b",)], "rcept_no string"))
    assert chunks._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") <= 2  # one for small and one for large tables
    got = [(r.chunk_id, r.chunk_type, r.section, r.n_chars, r.text[-2:]) for r in chunks.orderBy("chunk_id").collect()]
    assert got == [("a_0001", "text", "S", 901, "x\n"), ("a_0002", "table", "S", 1500, "||"), ("a_0003", "text", "T", 2, "\ny"), ("a_0004", "table", "S", 1, "t"), ("b_0001", "text", None, 1, "z")]


def test_tidy_texts_need_no_cleaning(spark):
    from filingloom import functions as fn

    texts = ["", " ", "a", "a b", "a  b", " a", "a ", "a\tb", "a\n \nb", "a\n", "\n", "a\xa0b", "가 나", "가　나", "\x1ca", "a\x1d", "é  x", "é", "a ", "x" * 9000 + " y" * 9000, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    for made, plain in ((fn.strip(c), fn.stripped(c)), (fn.clean_text(c), F.coalesce(fn.stripped(F.regexp_replace(c, rf"(?U){fn.SPACE}+", " ")), F.lit("")))):
        assert df.where(~made.eqNullSafe(plain)).count() == 0
    assert [r.x for r in df.select(fn.clean_cell(c).alias("x")).collect()][:10] == ["", "", "a", "a b", "a b", "a", "a", "a b", "a\nb", "a"]


def test_forms_give_the_same_rows(spark):
    from filingloom.operators import exchange, forms

    odd = ["<p>a 1&frac12; 2</p>", "<p>x > 12 <b>3</b></p>", '<p class="> 5 <">6</p>', "<p>1,234.50 1.2.3 12) 3. 4,</p>", "<p> 7</p>", "<script>if (a<b) 9</script>", "<!-- 8 --><p>&#49;2 A&B 3</p>", "", "<p>5", "<p>007 8,9,10</p>"]
    alike = [f"<html><table><tr><td>1. Sum</td></tr><tr><td>Total {n}</td><td>{n}.5</td></tr></table></html>" for n in range(20)]
    headed = [f"<html><table><tr><td>{h}</td></tr><tr><td>k</td><td>{h}</td></tr></table></html>" for h in ("4.5", "6.7", "1. Year 2020", "1. Year 2021", "10")]
    some = filings(spark, *odd, *alike, *headed)
    cases, every = forms.formed(some)
    assert cases.join(every.withColumnRenamed("rcept_no", "form"), "form").where("contains(markup, 'Total')").select("form").distinct().count() == 1
    for style in ("pipeline", "periodic", "exchange"):
        cols = ["rcept_no", "block_no", "type", "text", "cells.text as cells"]
        direct = markup.filing_blocks(some, style).selectExpr(*cols)
        again = forms.refilled(markup.filing_blocks(every, style).selectExpr(*cols), cases, ("text",), ("cells",)).select(direct.columns)
        assert sorted(map(str, direct.collect())) == sorted(map(str, again.collect()))
    grids = tables.gridded(markup.filing_blocks(every, "exchange"), "origin")
    unclear = exchange.marked_headers(tables.exchange_rows(grids))
    cases, own = forms.apart(some, cases, unclear)
    assert own.count() == 4  # whose first cells are headers by their numbers
    both = grids.join(unclear, "rcept_no", "left_anti").unionByName(tables.gridded(markup.filing_blocks(own, "exchange"), "origin"))
    made = forms.refilled(exchange.exchange_sections(both)[0], cases, lists=("lines",))
    plain = exchange.exchange_sections(tables.gridded(markup.filing_blocks(some, "exchange"), "origin"))[0]
    assert sorted(map(str, made.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_chunks_of_forms(spark):
    xml = lambda body: f"<DOCUMENT><BODY>{body}</BODY></DOCUMENT>"
    section = lambda n, *texts: f"<SECTION-1><TITLE>Line {n}</TITLE>{''.join(f'<P>{t}</P>' for t in texts)}</SECTION-1>"
    table = lambda *cells: f"<TABLE><TR>{''.join(f'<TD>{c}</TD>' for c in cells)}</TR></TABLE>"
    plain = [xml(section(i, f"part {i}", "same") + table(i, f"{i},000") + f"<P>end {i}</P>") for i in (7, 123, 4567)]
    close = [xml(section(1, "a" * 1390 + f" {n} b", "more")) for n in (5, 123456, 12345678)]  # the number decides whether it is cut
    wide = [xml(table(*["c" * 280] * 10, n)) for n in ("1", "9" * 300)]
    same = [xml(section(i, "x") + section(j, "y")) for i, j in ((1, 1), (1, 2))]  # so do these of one buffer or two
    bad = [xml(section(1, "kept") + table(i).replace("<TD>", '<TD ROWSPAN="x">')) for i in (1, 2)]
    meta = lambda d: d.select("rcept_no", F.concat(F.lit("m"), "rcept_no").alias("m"))
    got = lambda c: sorted(map(repr, c.collect()))
    for some, how, fits in ((plain, "raise", 3), (plain + close + wide + same, "raise", 5), (plain + bad, "warn", 3)):
        d = filings(spark, *some)
        one_by_one = documents.periodic_texts(tables.gridded(markup.filing_blocks(d, "periodic"), "repeat"))
        cases, every = forms.formed(d)
        texts = documents.periodic_texts(tables.gridded(markup.filing_blocks(every, "periodic"), "repeat"))
        assert got(periodic.chunk_forms(texts, cases, meta(d), how)) == got(periodic.chunk_periodic(one_by_one, meta(d), how))
        room = periodic.rooms(texts, periodic.buffered(texts, periodic.ANY))
        assert cases.join(room, "form").where(F.coalesce(F.array_max(F.transform("numbers", F.length)), F.lit(0)) <= F.col("_room")).count() == fits


def test_a_file_for_each_row(spark, tmp_path):
    names = ["5", "a b+é 보", "x=1/2:%[y]{z}^'\"#*?\\", "5", "", None]  # equal names keep a file each
    rows = spark.createDataFrame([(n, f"text {i}\nend") for i, n in enumerate(names)], "name string, value string")
    sources.write_files(rows.coalesce(1), f"{tmp_path}/own", "name")
    rows.write.partitionBy("name").text(f"{tmp_path}/spark")
    folders = lambda kind: sorted(p.name for p in (tmp_path / kind).iterdir() if p.is_dir())
    assert folders("own") == folders("spark")
    read = sources.scan_markdown(spark, f"{tmp_path}/own", "*.txt", named_by="folder")
    assert sorted(r.text for r in read.collect()) == [f"text {i}\nend\n" for i in range(len(names))]
    files = sorted(p for p in (tmp_path / "own").rglob("*") if p.is_file())
    assert len(files) == len(names) and not any(p.name.startswith(".") for p in files)
    sources.write_files(rows.coalesce(1), f"{tmp_path}/own", "name")  # as a task that runs again
    assert sorted(p for p in (tmp_path / "own").rglob("*") if p.is_file()) == files
    sources.write_files(rows.limit(0), f"{tmp_path}/none", "name")
    assert sources.scan_filings(spark, f"{tmp_path}/none", "*.txt").count() == 0


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    rows = spark.range(40).selectExpr("cast(id as string) as name", "'x' as value")
    sources.write_files(rows, f"{tmp_path}/files", "name")
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, jobs = spark.conf.get(name), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "")
    assert sources.listed(spark, lambda: spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(f"{tmp_path}/files")).count() == 40
    stages = [jobs.getStageInfo(s) for j in jobs.getJobIdsForGroup("listing") for s in jobs.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism and spark.conf.get(name) == before


def test_pages_of_one_id_are_files_of_their_own(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "bc"), (2, None)], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted((r.page_id, r.bytes) for r in queries.scanned_filings(spark, str(tmp_path)).collect()) == [(1, 2), (1, 3), (2, 1)]


def test_documents_are_one_paragraph_whatever_they_look_like(spark, tmp_path):
    texts = ["4111111111111111. One\n# two\n\n| x |\n> q\n- i\r\nplain\n", "", None, " ", "a\r\n\ue000\n\ue000\n\n", "plain"]
    rows = [(i, t, lang, source) for i, t in enumerate(texts) for lang, source in [("en", "s")]] + [(7, "- a", None, "s"), (8, "b\n\nc", "", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 5), (0, 1, 4), (2, 3, 6), (7, 1, 1)], "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    table = lambda *rows: "\n".join(["| line | part |", "| --- | --- |", *rows])
    tables = {0: table("| 1 | 4 |", "| 1 | 5 |"), 2: table("| 3 | 6 |"), 7: table("| 1 | 1 |")}
    want = []
    for i, t, lang, source in rows:
        heads = [None if x is None else s + x for s, x in (("# ", source), ("## ", lang))]
        path = None if None in (source, lang) else f"{source} > {lang}"
        want += [(i, 1, "heading", heads[0], ""), (i, 2, "heading", heads[1], source), (i, 3, "paragraph", t or "", path)]
        want += [(i, 4, "table", tables[i], path)] if i in tables else []
    assert [tuple(r) for r in queries.markdown_blocks(spark, str(tmp_path)).orderBy("doc_id", "block_no").collect()] == want
    chunks = {r.chunk_id: r.text for r in queries.markdown_chunks(spark, str(tmp_path)).collect()}
    assert chunks["0_0"] == f"# s\n\n## en\n\n{texts[0]}\n\n{tables[0]}" and chunks["1_0"] == "# s\n\n## en\n\n"


@pytest.fixture(scope="module")
def few_orders(spark, tmp_path_factory):
    """Tables of forty orders with up to three lines each."""
    path = tmp_path_factory.mktemp("orders")
    orders = spark.range(40).selectExpr("id as o_orderkey", "id % 3 as o_custkey", "element_at(array('F', 'O', 'P'), cast(id % 3 + 1 as int)) as o_orderstatus", "cast(1000 + id as double) as o_totalprice", "timestamp'1995-01-01' as o_orderdate", "'1-URGENT' as o_orderpriority")
    lines = spark.range(40).selectExpr("id", "explode(sequence(0, cast(id % 4 as int))) as n").where("n > 0").selectExpr("id as l_orderkey", "id % 7 as l_partkey", "id % 5 as l_suppkey", "n as l_linenumber", "cast(n as double) as l_quantity", "cast(10 * id as double) as l_extendedprice", "timestamp'1995-02-01' as l_shipdate", "'N' as l_returnflag")
    customers = spark.range(3).selectExpr("id as c_custkey", "concat('Customer ', id) as c_name", "'BUILDING' as c_mktsegment")
    for name, rows in (("orders", orders), ("lineitem", lines), ("customer", customers)):
        rows.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_failed_filings_are_read_once_for_each_form(spark, few_orders, monkeypatch):
    from filingloom.plans import fixtures as fx

    read, blocks_of = [], markup.filing_blocks

    def counted(filings, *args, **more):
        read.append(filings.count())
        return blocks_of(filings, *args, **more)

    monkeypatch.setattr(markup, "filing_blocks", counted)
    got = {(r.family, r.rcept_no): (r.status, r.n_blocks, r.n_chunks, r.empty_blocks, r.error) for r in queries.failed_filings(spark, few_orders).collect()}
    assert len(got) == 80 and max(read) < 40
    known = metadata.attach_manifest(fx.filing_names(spark, few_orders), fx.manifest(spark, few_orders)).withColumns({"company_name": F.lit(""), "report_name": F.lit("")})
    texts = documents.periodic_texts(tables.gridded(blocks_of(fx.damaged(fx.xml_filings(spark, few_orders), ' ROWSPAN="2"', "<BODY>"), "periodic"), "repeat"))
    logs = {"periodic": report.run_log(known, texts, periodic.chunk_periodic(texts, metadata.document_metadata(known, "periodic"), "warn"))}
    sections, failed = exchange.exchange_sections(tables.gridded(blocks_of(fx.damaged(fx.exchange_filings(spark, few_orders), ' rowspan="1"', "<table>"), "exchange"), "origin"))
    sections = sections.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True)
    chunks = exchange.chunk_exchange(sections, metadata.document_metadata(known.drop("path"), "exchange"), "warn")
    logs["exchange"] = report.run_log(known, sections.withColumnRenamed("section_no", "block_no"), chunks, "exchange")
    assert got == {(family, r.rcept_no): (r.status, r.n_blocks, r.n_chunks, r.empty_blocks, r.error) for family, log in logs.items() for r in log.collect()}


def test_long_texts_and_tables_are_split_once(spark):
    kinds = "rcept_no string, block_no int, type string, section_path array<string>, text string"
    rows = "\n".join(["|h|", "|-|", *[f"|{'r' * 98}|"] * 40])
    blocks = spark.createDataFrame([("a", 1, "text", ["S"], "x" * 2000), ("a", 2, "table", ["S"], rows), ("a", 3, "table", ["S"], "w" * 3100), ("a", 4, "text", ["S"], "end"), ("a", 5, "table", ["S"], None)], kinds)
    chunks = periodic.chunk_periodic(blocks, blocks.select("rcept_no").distinct())
    for plan in (chunks, markdown.split_text(blocks), markdown.split_table(blocks)):
        made = plan._jdf.queryExecution().optimizedPlan().toString()
        assert made.count("MapInArrow") <= 1 and made.count("ArrowEvalPython") <= 1
        assert not [line for line in made.splitlines() if "Filter" in line and ("aggregate(" in line or "split(" in line)]
    got = [(r.chunk_id, r.n_chars, r.text[:3]) for r in chunks.orderBy("chunk_id").collect()]
    assert got == [("a_0001", 1400, "xxx"), ("a_0002", 750, "xxx"), ("a_0003_p1", 2906, "|h|"), ("a_0003_p2", 1106, "|h|"), ("a_0005", 3, "end"), ("a_0006", 0, "")]


def test_driver_keeps_no_files(spark, tmp_path, monkeypatch):
    made = {"a/b/c/1.md": "one", "a/b/2.md": "", "3.md": "three \xe9", "a=1/_x=2/4.md": "four"}
    left = ["_h/5.md", ".6.md", "a/.h/7.md", "_8.md", "9.txt", "a/10.md._COPYING_"]
    for name in [*made, *left]:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(made.get(name, "left out"))
    plain = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(str(tmp_path), wholetext=True)
    for most in (1000, 1):
        monkeypatch.setattr(sources, "FOLDERS", most)
        got = sources.scan_markdown(spark, str(tmp_path))
        assert not got.inputFiles()  # no list of files in the driver's plan
        assert sorted(r.text for r in got.collect()) == sorted(r.value for r in plain.collect()) == sorted(filter(None, made.values()))
        binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").load(str(tmp_path))
        some = sources.scan_filings(spark, str(tmp_path), "*.md")
        assert sorted(map(tuple, some.select("path", "content").collect())) == sorted(map(tuple, binary.select("path", "content").collect()))
        assert [r.rcept_no for r in sources.scan_filings(spark, str(tmp_path), "*.md", limit=2).orderBy("path").collect()] == ["3", "1"]


def test_markdown_of_forms(spark, few_orders, monkeypatch):
    from filingloom.plans import fixtures as fx

    heads = lambda a, b: f"<DOCUMENT><DOCUMENT-NAME>Of {a}</DOCUMENT-NAME><COMPANY-NAME>C {b}</COMPANY-NAME><BODY><TABLE><TR><TD>{a}</TD><TD>x</TD></TR><TR><TD>{b}</TD><TD>x</TD></TR><TR><TE>{a}</TE><TE>{b}</TE></TR></TABLE><P>{a} A&B {b}</P></BODY></DOCUMENT>"
    some = fx.xml_filings(spark, few_orders).unionByName(filings(spark, heads(1, 2), heads(5, 5), heads("1,000", "1,000"))).localCheckpoint()
    clean = some.withColumn("markup", sanitize_markup(F.col("markup")))
    blocks_of, read = markup.filing_blocks, []
    blocks = blocks_of(clean, "pipeline")
    plain = documents.to_markdown(metadata.document_meta(documents.document_header(blocks)), tables.gridded(blocks, "shared"))
    monkeypatch.setattr(fx, "xml_filings", lambda *_: some)
    monkeypatch.setattr(markup, "filing_blocks", lambda filings, *args, **more: (read.append(filings.count()), blocks_of(filings, *args, **more))[1])
    got = {r.rcept_no: r.markdown for r in queries.filing_markdown(spark, few_orders).collect()}
    assert got == {r.rcept_no: r.markdown for r in plain.collect()} and len(got) == 43
    assert "| 5 | x |" in got["r1"] and "| 1 2 | x |" in got["r0"]
    assert sum(read) < 43


def test_periodic_markdown_is_made_in_a_filings_row(spark, few_orders, monkeypatch):
    from filingloom.plans import fixtures as fx

    section = lambda n, *texts: f"<SECTION-1><TITLE>Line {n}</TITLE>{''.join(f'<P>{t}</P>' for t in texts)}<TABLE><TR><TD>{n}</TD></TR></TABLE></SECTION-1>"
    pair = lambda a, b: f"<DOCUMENT><COMPANY-NAME>C {a}</COMPANY-NAME><BODY>{section(a, 'x', b)}{section(b, a)}</BODY></DOCUMENT>"
    some = fx.xml_filings(spark, few_orders).unionByName(filings(spark, pair(1, 2), pair(3, 3), "<DOCUMENT><BODY></BODY></DOCUMENT>", "<DOCUMENT><COMPANY-NAME>D</COMPANY-NAME></DOCUMENT>")).localCheckpoint()
    blocks = markup.filing_blocks(some, "periodic").localCheckpoint()
    monkeypatch.setattr(fx, "xml_filings", lambda *_: some)
    made = queries.periodic_markdown(spark, few_orders)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan  # no filing's blocks are gathered one by one
    plain = documents.render_document(documents.document_header(blocks), documents.periodic_texts(tables.gridded(blocks, "repeat")))
    got = {r.rcept_no: r.markdown for r in made.collect()}
    assert got == {r.rcept_no: r.markdown for r in plain.collect()} and len(got) == 43
    assert got["r0"] == "# C 1 - \n\n\n## Line 1\nx\n2\n\n| 1 |\n| --- |\n\n\n## Line 2\n1\n\n| 2 |\n| --- |\n" and got["r1"].count("## Line 3") == 1


def test_chunk_files_take_little_disk(spark, few_orders, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "own_folder", lambda _: str(tmp_path / "chunks"))
    rows = queries.chunk_files(spark, few_orders)
    lines = spark.read.text(str(tmp_path / "chunks")).count()
    files = [p for p in (tmp_path / "chunks").iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".json.gz") for p in files) and lines == rows.count()
    own = queries.exchange_chunks(spark, few_orders)
    assert sorted((r.chunk_id, r.text, r.corp_name) for r in rows.collect()) == sorted((r.chunk_id, r.text, r.corp_name) for r in own.collect())
    steps = [line.strip(" :+-") for line in own._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert steps.index(next(x for x in steps if x.startswith("Generate"))) < steps.index(next(x for x in steps if x.startswith("Join")))  # filings meet their metadata, not sections


def test_payload_is_made_in_a_filings_row(spark, few_orders, monkeypatch, tmp_path):
    from filingloom.plans import fixtures as fx

    row = lambda *cells: f"<TR>{''.join(cells)}</TR>"
    td, te = lambda x: f"<TD>{x}</TD>", lambda x, more="": f"<TE{more}>{x}</TE>"
    odd = [f"<DOCUMENT><COMPANY-NAME>C {n}</COMPANY-NAME><BODY><P>a {n}</P><TABLE>{row(td(n), td(m), te('1,234.5'), te('-'), te(' x '), te(20200102), te('d', ' AUNITVALUE=\"20210304\"'), te(''), te(m))}</TABLE><P> </P></BODY></DOCUMENT>" for n, m in ((1, 2), (5, 5), ("1,000", 7))]
    some = fx.xml_filings(spark, few_orders).unionByName(filings(spark, *odd)).localCheckpoint()
    blocks = markup.filing_blocks(some, "pipeline", sanitize=True).localCheckpoint()
    by = lambda df: df.withColumn("doc_id", F.concat(F.lit("D"), "rcept_no")).drop("rcept_no")
    fields = by(tables.table_fields(tables.gridded(blocks, "shared"))).select("doc_id", F.struct("block_no", "row", "col").alias("pos"), "label", "value", "value_type")
    text = by(documents.paragraphs(blocks)).select("doc_id", F.col("block_no").alias("pos"), "text")
    plain = sources.normalized_payload(by(documents.document_header(blocks)), fields, text, fx.manifest(spark, few_orders))
    monkeypatch.setattr(fx, "xml_filings", lambda *_: some)
    monkeypatch.setattr(queries, "own_folder", lambda _: str(tmp_path / "payload"))
    shuffled, write = [], queries.write_normalized
    monkeypatch.setattr(queries, "write_normalized", lambda df, path: (shuffled.append(df._jdf.queryExecution().optimizedPlan().toString()), write(df, path)))
    assert queries.payload(spark, few_orders).count() == 43
    assert "Aggregate" not in shuffled[0]  # fields and paragraphs of filings aren't gathered one by one
    made = spark.read.parquet(str(tmp_path / "payload"))
    cols = ["doc_id", "company_name", "company_regcik", "fields", "paragraphs", "manifest_corp_name"]
    assert sorted(map(str, made.select(cols).collect())) == sorted(map(str, plain.select(cols).collect()))
