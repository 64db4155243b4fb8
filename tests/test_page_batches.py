import random

import pyarrow as pa
import pytest

from forecourt.functions import page_batches
from forecourt.functions.pages import read_page

FRAGMENTS = [
    "<tr>", "</tr>", "<th>", "</th>", "<td>", "</td>", "<bdi>", "</bdi>", '<p class="price">', "</p>",
    "<span class='x amount'>", "</span>", "<br>", "<b>", "</b>", "text", "&amp", "&am", "p;", "<!--", "-->", "<!x>",
    "<script>", "</script>", '<script src="a>b">', "<style/>", "<th/>", "<tr/>", "<bdi/>", '"', "'", "<", ">", "</",
    "é", "<É>", "<bé>", "</ b>", "<blockquote>", "</blockquote>", "<figcaption class=price>", "</figcaption>",
    '<TD CLASS="Amount">', " ", "\x1f", "\x00", "<b\x00>", "<a t=\"'\">", "Año", "İ", '<p class="&#112;rice">',
    '<p class="price amount">', '<b title="<!--">', '<div class="amount"><bdi>3</bdi></div>',
    "<tr><th>h</th><td>v</td></tr>", "<tr><th>H</th><td>w<i>&lt</i></td></tr>", "<!-->", "<style>x</style >",
]
ELEMENTS = ["tr", "th", "td", "bdi", 'p class="price"', "span class='x amount'", "b", "blockquote", "TR",
            "i class=amount", 'a x="y>z"']
INSIDE = ["x", "&lt;", " y ", "<br>", "<!-- c -->", "<script>q</script>", '<img src="x"/>', "<!x>", "&am", "p;"]


def nested(draw, depth=0):
    parts = []
    for _ in range(draw.randrange(1, 5)):
        if depth < 5 and draw.random() < 0.5:
            name = draw.choice(ELEMENTS)
            parts.append(f"<{name}>{nested(draw, depth + 1)}</{name.split()[0]}>")
        else:
            parts.append(draw.choice(FRAGMENTS if draw.random() > 0.97 else INSIDE))
    return "".join(parts)


def compared(pages):
    specs, prices = page_batches.read_pages(pa.array(pages, pa.string()))
    found = list(zip(specs.to_pylist(), prices.to_pylist(), strict=True))
    for page, one in zip(pages, found, strict=True):
        labels, price = read_page(page)
        assert one == (list(labels.items()), price), page


@pytest.mark.parametrize("seed", range(4))
def test_batches_read_as_single_pages(seed, monkeypatch):
    draw = random.Random(seed)
    monkeypatch.setattr(page_batches, "PORTION", draw.choice([1, 100, 1 << 20]))
    loose = ["".join(draw.choice(FRAGMENTS) for _ in range(draw.randrange(14))) for _ in range(1500)]
    compared([None, "", *loose, *[nested(draw) for _ in range(1500)]])


def test_slices_and_empty_batches():
    compared([])
    compared([None, "", None])
    pages = pa.array(["<p>", None, "<tr><th>a</th><td>b</td></tr>", "<th>"])[1:3]
    specs, prices = page_batches.read_pages(pages)
    assert specs.to_pylist() == [[], [("a", "b")]] and prices.to_pylist() == ["0", "0"]


def test_well_nested_pages_are_not_read_one_by_one(monkeypatch):
    """This held up every query that reads pages: a page took about 0.2 ms of its own."""
    def refused(page):
        raise AssertionError(page)

    monkeypatch.setattr(page_batches, "read_page", refused)
    page = ('<html><!-- <td> --><script>"<tr>"</script><p class="price"><b class=amount><bdi>{0},5&nbsp;<i>&euro;</i>'
            "</bdi></b></p><table><tr><th><b>A&ntilde;o</b></th><td> {0} </td></tr></table></html>")
    specs, prices = page_batches.read_pages(pa.array([page.format(i) for i in range(3000)]))
    assert specs.to_pylist() == [[("año", str(i))] for i in range(3000)]
    assert prices.to_pylist() == [f"{i},5\xa0€" for i in range(3000)]


def test_bytes_are_looked_through_once_for_marks(monkeypatch):
    """Each further scan of all bytes, and each table look-up by letter, was paid on every page."""
    scanned, found = [], page_batches.np.flatnonzero
    page = '<TABLE><tr class="x"><TH>A</TH><td title=\'y\'>1</td></tr></TABLE>'
    n = 500 * len(page)
    monkeypatch.setattr(page_batches.np, "flatnonzero", lambda a: scanned.append(len(a) == n) or found(a))
    specs, _ = page_batches.read_pages(pa.array([page] * 500))
    assert specs.to_pylist() == [[("a", "1")]] * 500
    assert sum(scanned) == 1


def test_names_with_every_byte():
    """Any character before, inside and after a name, in names shorter and longer than eight letters."""
    signs = [chr(c) for c in range(256)]
    compared([
        f"<tr><th>a</th>{tag}</tr>" for c in signs for tag in (
            f"<td{c}>v</td{c}>", f"<t{c}d>v</td>", f"<{c}td>v</td>", f"<td {c}>v</td>", f"<TD>v</TD{c}x>",
            f"<blockqu{c}>v</blockqu{c}>", f"<blockquo{c}><td>v</td></blockquo{c}>")])
