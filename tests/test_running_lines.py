from pyspark.sql import functions as F

from millrace.functions.pages import pages_by_lines, without_running_lines


def test_heads_and_feet_that_move_with_the_chapter(spark):
    rows = []
    for page in range(8):
        head = "One" if page < 4 else "Two"
        rows.append(("d", page, f"\n{head}\nbody {chr(97 + page) * 3}\nOne\nmore {chr(107 + page)}\n \nPage {page} of 8"))
    rows += [("e", 0, "One\nx"), ("e", 1, "One\ny"), ("f", 0, None), ("f", 1, ""), (None, 0, "k")]
    pages = spark.createDataFrame(rows, "doc string, pagenum int, page_text string").withColumn("place", F.lit("extra"))
    found = {(r.doc, r.pagenum): r for r in without_running_lines(pages.repartition(3), "doc", "page_text").collect()}
    assert len(found) == len(rows)
    for page in range(8):
        assert found["d", page].n_running == 2
        assert found["d", page].body_text == f"\nbody {chr(97 + page) * 3}\nOne\nmore {chr(107 + page)}\n "
    assert found["e", 0].body_text == "One\nx" and found["e", 0].n_running == 0  # on two pages only
    assert found["f", 0].body_text is None and found["f", 1].body_text == "" and found[None, 0].body_text == "k"


def test_pages_of_lines(spark):
    df = spark.createDataFrame([(1, "a\nb\n\nc\nd"), (2, "")], "id int, t string")
    found = sorted((r.id, r.pagenum, r.total_pages, r.page_text) for r in pages_by_lines(df, "t", lines=2).collect())
    assert found == [(1, 0, 3, "a\nb"), (1, 1, 3, "\nc"), (1, 2, 3, "d"), (2, 0, 1, "")]
    assert without_running_lines(pages_by_lines(df.limit(0), "t"), "id", "page_text").count() == 0
