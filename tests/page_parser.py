"""A page reader on the standard library's parser: what the expressions are held against."""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
SILENT = {"script", "style", "template"}


class _Page(HTMLParser):
    """Collects table rows, the price node and link targets."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, frozenset[str], list]] = []
        self.rows: list[dict[str, list[str]]] = []
        self.price: list[str] | None = None
        self.links: dict[str, None] = {}

    def handle_starttag(self, tag, attrs):
        values = dict(attrs)
        if tag == "a" and values.get("href"):
            self.links.setdefault(values["href"])
        captures: list = []
        if tag == "tr":
            row: dict[str, list[str]] = {}
            self.rows.append(row)
            captures.append(row)
        elif tag in ("th", "td"):
            for _, _, held in list(self.open):
                for row in held:
                    if isinstance(row, dict) and tag not in row:
                        row[tag] = []
                        captures.append(row[tag])
        elif tag == "bdi" and self.price is None and self._below("price", "amount"):
            self.price = []
            captures.append(self.price)
        if tag not in VOID:
            classes = frozenset((values.get("class") or "").split())
            self.open.append((tag, classes, captures))

    def _below(self, outer: str, inner: str) -> bool:
        places = [i for i, (_, classes, _) in enumerate(self.open) if outer in classes]
        return bool(places) and any(inner in c for _, c, _ in self.open[places[0] + 1:])

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open and self.open[-1][0] in SILENT:
            return
        for _, _, captures in self.open:
            for capture in captures:
                if isinstance(capture, list):
                    capture.append(data)


def read_page(html: str | None) -> tuple[dict[str, str], str, list[str]]:
    """(label map, price text, distinct links) of one page."""
    page = _Page()
    page.feed(html or "")
    page.close()
    specs = {
        "".join(row["th"]).strip().lower(): "".join(row["td"]).strip()
        for row in page.rows if "th" in row and "td" in row
    }
    price = "0" if page.price is None else "".join(page.price).strip()
    return specs, price, list(page.links)
