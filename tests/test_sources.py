import pytest
from pyspark.sql import functions as F

from docsheaf.sources import captures, files, page_texts
from docsheaf.sources.union import number_by, union_sources


def test_text_files(spark, tmp_path):
    contents = {
        "a.txt": "café\r\nx\ry".encode(),
        "b.TXT": b"caf\xe9",
        "sub/c.txt": b" \n",
        "d.md": b"no",
        "e": b"no",
        "f.tar.txt": "﻿ok".encode(),
        "g.pdf": b"%PDF",
        "empty.txt": b"",
        "_under.txt": b"u",
        ".hidden.txt": b"h",
        "sub/_deep/h.txt": b"deep",
    }
    for name, content in contents.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True, parents=True)
        path.write_bytes(content)
    found = files.scan_files(spark, str(tmp_path)).cache()
    short = lambda s: s.split(tmp_path.name + "/")[1]
    texts = {short(r.source): r.raw_text for r in files.read_text_files(found).collect()}
    assert texts == {"a.txt": "café\nx\ny", "b.TXT": "café", "sub/c.txt": " \n", "f.tar.txt": "﻿ok",
                     "empty.txt": "", "_under.txt": "u", ".hidden.txt": "h", "sub/_deep/h.txt": "deep"}
    rejects = {short(r.source): r.reason for r in files.unsupported_files(found).collect()}
    assert rejects == {n: f"unsupported file type '{e}'" for n, e in (("d.md", ".md"), ("e", ""))}

    first = found.select("source").first().source
    wanted = spark.createDataFrame([(first,), ("file:/none.txt",)], "source string")
    assert [tuple(r) for r in files.missing_files(wanted, found).collect()] == [
        ("file:/none.txt", "ingest", "file not found")
    ]
    numbered = number_by(files.read_text_files(found), "source").orderBy("position").collect()
    assert [short(r.source) for r in numbered] == sorted(texts)

    pages = spark.createDataFrame([], "source string")
    assert [short(r.source) for r in files.pdfs_without_pages(found, pages).collect()] == ["g.pdf"]
    gone = files.read_contents(spark.createDataFrame([(f"file://{tmp_path}/gone.txt",)], "source string"))
    (reject,) = files.unreadable_files(gone).collect()
    assert reject.reason.startswith("cannot be read")


def test_positions_are_dense_and_checked(spark):
    docs = spark.range(3000).select(F.concat(F.lit("f"), F.lpad("id", 5, "0")).alias("source"))
    rows = number_by(docs, "source", partitions=200).collect()
    assert sorted((r.source, r.position) for r in rows) == [(f"f{k:05}", k) for k in range(3000)]
    wide = spark.range(1).select(
        F.lit(1 << 40).alias("position"), F.lit("s").alias("source"), F.lit("url").alias("source_type"), F.lit("t").alias("raw_text")
    )
    with pytest.raises(Exception, match="position out of range"):
        union_sources((wide, "position")).collect()


def test_suffix(texts):
    paths = ["a/b.TXT", "a.txt/b", "a/.txt", "a/b.tar.txt", "a/b.", "..txt"]
    assert texts(files.suffix, paths) == [".txt", "", "", ".txt", "", ".txt"]


def test_pages_join_in_order(spark):
    rows = [("d", n, f"p{n}", False) for n in range(1000)]
    rows[3] = ("d", 3, None, False)
    rows[5] = ("d", 5, "lost", True)
    rows += [("blank", 0, " ", False), ("blank", 1, None, False), ("failed", 0, "x", True)]
    pages = spark.createDataFrame(rows, page_texts_schema())
    pages = pages.repartition(7)
    (doc,) = page_texts.read_page_documents(pages).collect()
    expected = [f"p{n}" if n != 3 else "" for n in range(1000) if n != 5]
    assert (doc.source, doc.source_type, doc.raw_text) == ("d", "file_pdf", "\n".join(expected))
    assert {r.source for r in page_texts.textless_documents(pages).collect()} == {"blank", "failed"}


def page_texts_schema():
    from docsheaf import schemas

    return schemas.PAGE_TEXTS


def test_content_type_dispatch(spark):
    html = "<article>a<p>b</article>"
    rows = [("1", "text/html", html), ("2", "TEXT/HTML", html), ("3", None, html), ("4", "text/plain", "x"), ("5", "text/html", "<p> </p>")]
    df = spark.createDataFrame(rows, "source string, content_type string, body string")
    docs = {r.source: r.raw_text for r in captures.read_captures(df).collect()}
    assert docs == {"1": "a\nb", "2": html, "3": html, "4": "x"}
    plan = captures.read_captures(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_union_keeps_source_order(spark):
    def docs(name, n):
        return spark.range(n).select(
            F.col("id").alias("position"), F.concat(F.lit(name), "id").alias("source"),
            F.lit("url").alias("source_type"), F.lit("t").alias("raw_text"),
        )

    both = union_sources((docs("f", 2), "position"), (docs("u", 3), "position")).orderBy("doc_seq")
    assert [r.source for r in both.collect()] == ["f0", "f1", "u0", "u1", "u2"]
