"""Reading one listing page in a single pass over its tags.

End tags close the nearest open element of their name and all inside it, which needs
a stack; array expressions would copy it at every tag.  So this is a small reader in
plain Python, run on Arrow batches by `operators.extract`.  Its time is linear in the
page and in the text it returns:

- each `<` is looked at once; where a tag never ends because of an open quote, later
  tags end at the next `>`, quoted or not, so that no text is searched twice;
- what hides text (comments, scripts, styles) is skipped to its end, or to the end
  of the page where it has none;
- an end tag without an open element of its name is known by a counter;
- a cell is handed once to all open rows that still wait for one.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
))
_FLAGS = re.IGNORECASE | re.ASCII
# Groups: slash of an end tag, name, attributes; without a name it is a comment or the like.
_TAG = re.compile(
    r"""<(?:!--|(/?)([a-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|(?:[!?]|/(?![a-z]))[^>]*>)""", _FLAGS)
_LOOSE = re.compile(r"<(?:!--|(/?)([a-z][^\s/>]*)([^<>]*)>|(?:[!?]|/(?![a-z]))[^<>]*>)", _FLAGS)
# A page that hides nothing is cut at once; the fifth group is a `<` that begins no plain tag.
_HIDES = re.compile(r"<(?:!--|script|style)", _FLAGS)
_PLAIN = re.compile(
    r"""([^<]*)<(?:(/?)([a-z][^\s/>]*)([^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+)>|[!?][^<>]*>|(?=(.)))""",
    _FLAGS | re.DOTALL)
_ELEMENT = re.compile(r"</?[a-z]", _FLAGS)
_HIDDEN_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", _FLAGS) for name in ("script", "style")}
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", _FLAGS)


def _tags(page: str) -> Iterable[tuple[str, str, str, str]]:
    """(text before, slash, name, attributes) of every tag; without a name where there is none."""
    if not _HIDES.search(page):
        found = _PLAIN.findall(page + "<?>")
        if not any(odd for *_, odd in found):
            return ((text, slash, name.lower(), attributes) for text, slash, name, attributes, _ in found)
    return _careful(page)


def _careful(page: str) -> Iterator[tuple[str, str, str, str]]:
    """The same of any page, tag by tag; the last one is the end of the page."""
    at, seen, pattern = 0, 0, _TAG
    text: list[str] = []
    while True:
        begin = page.find("<", seen)
        if begin < 0:
            break
        found = pattern.match(page, begin)
        if not found:
            if pattern is _TAG and _ELEMENT.match(page, begin):
                pattern = _LOOSE
            elif pattern is _TAG and page[begin + 1: begin + 2] in ("!", "?", "/"):
                break  # there is no `>` any more
            else:
                seen = begin + 1
            continue
        text.append(page[at: begin])
        at = seen = found.end()
        slash, name, attributes = found.groups()
        if name is None:
            if found[0] == "<!--":
                end = page.find("-->", at)
                at = seen = len(page) if end < 0 else end + 3
            continue
        name = name.lower()
        yield "".join(text), slash, name, attributes
        text = []
        if name in _HIDDEN_END and not slash and not attributes.endswith("/"):
            end = _HIDDEN_END[name].search(page, at)
            at = seen = end.end() if end else len(page)
    text.append(page[at:])
    yield "".join(text), "", "", ""


def _classes(attributes: str) -> list[str]:
    if "class" in attributes.lower():
        for name, value in _ATTRIBUTE.findall(attributes):
            if name.lower() == "class":
                return unescape(value[1:-1] if value[:1] in ("'", '"') else value).split()
    return []


def read_page(page: str | None) -> tuple[dict[str, str], str]:
    """(labels and values of the rows that have a header and a cell, text of the price node) of one page.

    Of a repeated label the last value stays.  A row's header and cell are the first
    `th` and `td` inside it.  The price node is the first `bdi` below an element of class
    `amount` below one of class `price`; '0' when there is none.  A missing page has neither.
    """
    texts: list[str] = []
    #: Name, level before, row, and the range of texts it ends, of each open element.
    stack: list[tuple[str, int, list | None, list | None]] = []
    count: dict[str, int] = {}
    rows: list[list] = []
    heads: list[list] = []  # open rows that wait for a header, and those that wait for a cell
    cells: list[list] = []
    price, level = None, 0
    for text, slash, name, attributes in _tags(page or ""):
        if text:
            texts.append(unescape(text) if "&" in text else text)
        if not name or name in VOID or name in _HIDDEN_END:
            continue
        if not slash:
            before, row, held = level, None, None
            if name == "tr":
                row = [None, None]
                rows.append(row)
                heads.append(row)
                cells.append(row)
            elif name == "th" or name == "td":
                waiting = heads if name == "th" else cells
                if waiting:
                    held = [len(texts), None]
                    for waits in waiting:
                        waits[name == "td"] = held
                    waiting.clear()
            elif name == "bdi" and level == 2 and price is None:
                held = price = [len(texts), None]
            if level < 2 and attributes:
                # 1 from an element of class `price` on, 2 from one of class `amount` below it.
                level += ("price", "amount")[level] in _classes(attributes)
            stack.append((name, before, row, held))
            count[name] = count.get(name, 0) + 1
            if not attributes.endswith("/"):
                continue
        if not count.get(name):
            continue
        closed = None
        while closed != name:
            closed, level, row, held = stack.pop()
            count[closed] -= 1
            if row is not None:
                if heads and heads[-1] is row:
                    heads.pop()
                if cells and cells[-1] is row:
                    cells.pop()
            if held is not None:
                held[1] = len(texts)

    def between(held: list) -> str:
        return "".join(texts[held[0]: held[1]]).strip()

    specs = {between(head).lower(): between(cell) for head, cell in rows if head and cell}
    return specs, "0" if price is None else between(price)
