"""Pages that mark their article are differenced, too."""

from vigil.llm import html_text


def test_template_lines_inside_articles_go(spark):
    def page(h, i, own):
        return (i, f"http://{h}/p{i:03}", f"<nav>menu</nav><article><p>Share this page</p><p>{own}</p><p>All rights with us</p></article>")

    rows = [page("a", i, f"the text of article number {i}, which is longer than its template") for i in range(40)]
    rows += [page("b", 40 + i, f"the text of article number {i}, which is longer than its template") for i in range(2)]  # one near page: no evidence
    rows += [page("c", 50 + i, "one text that was copied to every page of this host, so it is no template") for i in range(6)]
    rows += [(60 + i, f"http://d/p{i}", f"<main><p>said on {'three' if i < 3 else 'no'} pages</p><p>only on page {i} of all the pages</p></main>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(pages, shards=4).collect()}
    assert {i: got[i] for i in range(40)} == {i: rows[i][2].split("<p>")[2].removesuffix("</p>") for i in range(40)}
    assert got[40].split("\n")[0] == "Share this page" and got[41].count("\n") == 2
    assert all(got[50 + i].count("\n") == 2 for i in range(6))  # copies stay whole
    # all near pages of the first page have its line, and all of the last page its own; the others have a near page without
    assert [got[60 + i].count("\n") for i in range(6)] == [0, 1, 1, 1, 1, 0]


def test_marked_lines_need_all_near_pages():
    lines = ["t", "own text", "t"]
    assert html_text.marked_difference(lines, [["t", "x", "t"], ["t", "y"]]) == ["own text", "t"]
    assert html_text.marked_difference(lines, [["t", "x", "t"]]) == lines
    assert html_text.marked_difference(lines, [["t"], ["x"]]) == lines
    assert html_text.marked_difference([], [["t"], ["t"]]) == []
