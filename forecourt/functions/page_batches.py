"""Reading the listing pages of an Arrow batch together.

The result is that of `pages.read_page` for each page.  All tags of a batch are found,
named and paired with numpy; nothing is looked at page by page but hidden parts and
texts with tags inside.  That holds for pages whose tags are whole and well nested,
whatever they are; every other page (an open quote, a `<` or `>` in the text, an element
without its end, an end without its element) goes through `read_page` by itself.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa

from forecourt.functions.pages import _HIDDEN_END, VOID, _classes, read_page

#: Bytes read at once.
PORTION = 1 << 20

_HIDDEN = re.compile(
    rb"""<(?:!--.*?(?:-->|\Z)|(script|style)(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*+(?<!/)>"""
    rb"""(?:.*?</\1(?=[\s/>])[^>]*>|.*))""",
    re.IGNORECASE | re.DOTALL)

_STOP = np.zeros(256, bool)
_STOP[[9, 10, 11, 12, 13, 32, 47, 62]] = True
_NAME = re.compile(rb"[^\s/>]*")


def _each(byte: int) -> np.uint64:
    """The byte in all eight places of a number."""
    return np.uint64(byte * 0x0101010101010101)


_TOP = _each(128)


def _word(name: str) -> int:
    """A name of at most eight letters as the number `_names` gives it."""
    return sum(ord(c) << 8 * k for k, c in enumerate(name))


_WITHOUT_EFFECT = np.array(sorted(map(_word, [*VOID, *_HIDDEN_END])), np.uint64)
_TR, _TH, _TD, _BDI = (np.uint64(_word(name)) for name in ("tr", "th", "td", "bdi"))


def read_pages(pages: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(labels and values, text of the price node) of every page, as `read_page` has them."""
    pages = pages.cast(pa.string()).fill_null("")
    offsets = np.frombuffer(pages.buffers()[1], np.int32)[pages.offset: pages.offset + len(pages) + 1]
    offsets = offsets.astype(np.int64)
    held = pages.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    specs, prices = [], []
    a = 0
    while a < len(pages):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PORTION, "right")) - 1)
        found = _Portion(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]).read()
        specs.append(found[0])
        prices.append(found[1])
        a = b
    if not specs:
        return pa.array([], pa.map_(pa.string(), pa.string())), pa.array([], pa.string())
    return pa.concat_arrays(specs), pa.concat_arrays(prices)


class _Portion:
    """Some pages: their bytes, and where each begins."""

    def __init__(self, data: np.ndarray, first: np.ndarray) -> None:
        self.data, self.first = data, first
        self.held = data.tobytes()
        #: What stands behind the last byte is never part of a name.
        self.padded = np.concatenate([data, np.zeros(10, np.uint8)])
        #: The eight bytes from each place on, as one number.
        self.eight = np.ndarray(len(data) + 3, "<u8", self.padded, strides=(1,))
        self.n = len(first) - 1
        self.whole = np.ones(self.n, bool)

    def page_of(self, at: np.ndarray) -> np.ndarray:
        """The page of every place, of ascending places."""
        return np.repeat(np.arange(self.n), np.diff(np.searchsorted(at, self.first)))

    def read(self) -> tuple[pa.Array, pa.Array]:
        self._tags()
        self._names()
        self._pairs()
        return self._collect(*self._rows(), self._prices())

    def _only_whole(self, *names: str) -> None:
        """Leave out the tags of pages that are not whole."""
        if self.whole.all():
            return
        keep = self.whole[self.page]
        for name in names:
            setattr(self, name, getattr(self, name)[keep])

    def _hidden(self, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, byte after the last) of comments, scripts and styles."""
        second, third = self.padded[begins + 1], self.padded[begins + 2]
        likely = begins[((second == 33) & (third == 45)) | (
            ((second | 32) == 115) & (((third | 32) == 99) | ((third | 32) == 116)))]
        pages, at = np.unique(self.page_of(likely), return_index=True)
        spans = []
        for a, b in zip(likely[at].tolist(), self.first[pages + 1].tolist(), strict=True):
            spans += [m.span() for m in _HIDDEN.finditer(self.held, a, b)]
        found = np.array(spans, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    def _tags(self) -> None:
        """begin and end (`<` and `>`) of every tag; a hidden part is one tag without a name."""
        data = self.data
        marks = np.flatnonzero((data == 60) | (data == 62) | (data == 34) | (data == 39))
        kind = data[marks]
        self.quotes = marks[kind == 34], marks[kind == 39]
        begin, end = marks[kind == 60], marks[kind == 62]
        starts, ends = self._hidden(begin)
        if len(starts):
            def outside(at: np.ndarray) -> np.ndarray:
                change = np.bincount(np.searchsorted(at, starts), minlength=len(at) + 1)
                change -= np.bincount(np.searchsorted(at, ends), minlength=len(at) + 1)
                return at[np.cumsum(change)[:-1] == 0]

            begin = np.sort(np.concatenate([outside(begin), starts]))
            end = np.sort(np.concatenate([outside(end), ends - 1]))
        of_begin, of_end = self.page_of(begin), self.page_of(end)
        self.whole &= np.bincount(of_begin, minlength=self.n) == np.bincount(of_end, minlength=self.n)
        begin, end = begin[self.whole[of_begin]], end[self.whole[of_end]]
        self.page = self.page_of(begin)
        self.whole[self.page[begin >= end]] = False
        self.whole[self.page[:-1][end[:-1] >= begin[1:]]] = False
        self.begin, self.end = begin, end
        self.hidden = np.zeros(len(begin), bool)
        if len(begin):
            place = np.searchsorted(begin, starts).clip(max=len(begin) - 1)
            self.hidden[place[begin[place] == starts]] = True
        self._only_whole("begin", "end", "hidden", "page")

    def _names(self) -> None:
        """Name of every tag, as up to two numbers; where its attributes begin, and what kind it is."""
        begin, end, n = self.begin, self.end, len(self.begin)
        second = self.padded[begin + 1]
        self.nameless = self.hidden | (second == 33) | (second == 63)
        self.closing = ~self.nameless & (second == 47)
        at = begin + 1 + self.closing
        letter = self.padded[at] | 32
        wrong = ~self.nameless & ((letter < 97) | (letter > 122))
        self.name = np.zeros(n, np.uint64)
        self.attributes = end.copy()
        named = np.flatnonzero(~self.nameless & ~wrong)
        word = self.eight[at[named]]
        stops = _STOP.take(word.view(np.uint8)).view("<u8")
        # All bits of the bytes before the first stop.
        inside = (stops & (~stops + np.uint64(1))) - np.uint64(1)
        size = np.bitwise_count(inside) >> 3
        # Neither zero nor above 127 stands in a name; capitals, 65 to 90, become small letters.
        filled = word | ~inside
        word &= inside
        wrong[named[(((filled - _each(1)) & ~filled | word) & _TOP) > 0]] = True
        capital = (word + _each(128 - 65)) & ~(word + _each(128 - 91)) & _TOP
        self.name[named] = word | (capital >> np.uint64(2))
        self.attributes[named] = at[named] + size
        self._long_names(named[size == 8], at, wrong)
        quotes = []
        for signs in self.quotes:
            tag = np.searchsorted(begin, signs, "right") - 1
            inside = (tag >= 0) & (signs < end[tag]) if n else np.zeros(len(signs), bool)
            quotes.append(np.bincount(tag[inside], minlength=n))
        open_quote = (quotes[0] % 2 > 0) | (quotes[1] % 2 > 0) | ((quotes[0] > 0) & (quotes[1] > 0))
        wrong |= ~self.nameless & open_quote
        without = np.searchsorted(_WITHOUT_EFFECT, self.name).clip(max=len(_WITHOUT_EFFECT) - 1)
        self.counts = ~self.nameless & (_WITHOUT_EFFECT[without] != self.name)
        ended = self.counts & ~self.closing & (self.padded[end - 1] == 47) & (end > self.attributes)
        # An element that ends in its own tag holds nothing; only as a cell or a price it says so.
        wrong |= ended & ((self.name == _TH) | (self.name == _TD) | (self.name == _BDI))
        self.counts &= ~ended
        self.whole[self.page[wrong]] = False
        self._only_whole("begin", "end", "page", "nameless", "closing", "name", "attributes", "counts")

    def _long_names(self, tags: np.ndarray, at: np.ndarray, wrong: np.ndarray) -> None:
        """Names of eight letters and more, numbered by what occurs."""
        texts: dict[bytes, int] = {}
        for tag in tags.tolist():
            found = _NAME.match(self.held, int(at[tag]), int(self.end[tag]))[0]
            wrong[tag] |= not found.isascii() or b"\0" in found
            self.name[tag] = texts.setdefault(found.lower(), len(texts)) | 1 << 63
            self.attributes[tag] = at[tag] + len(found)

    def _pairs(self) -> None:
        """The end tag of every element; pages with any tag that has no other are left out."""
        step = np.where(self.counts, np.where(self.closing, -1, 1), 0)
        depth = np.cumsum(step)
        # The depth each page begins at.
        before = np.concatenate([[0], depth])[np.searchsorted(self.page, np.arange(self.n))]
        depth -= before[self.page]
        self.whole[self.page[depth < 0]] = False
        last = np.searchsorted(self.page, np.arange(self.n), "right") - 1
        some = np.bincount(self.page, minlength=self.n) > 0
        self.whole[some] &= depth[last[some]] == 0
        keep = self.whole[self.page]
        step, depth = step[keep], depth[keep]
        self._only_whole("begin", "end", "page", "nameless", "closing", "name", "attributes", "counts")
        elements = np.flatnonzero(self.counts)
        level = depth[elements] + (step[elements] < 0)
        level = level.astype(np.uint16) if not len(level) or level.max() < 1 << 16 else level
        pairs = elements[np.argsort(level, kind="stable")].reshape(-1, 2)
        self.whole[self.page[pairs[self.name[pairs[:, 0]] != self.name[pairs[:, 1]], 0]]] = False
        self.partner = np.zeros(len(self.begin), np.int64)
        self.partner[pairs[:, 0]] = pairs[:, 1]
        #: Opening tags of elements, on whole pages.
        self.opens = self.counts & ~self.closing & self.whole[self.page]

    def _named(self, name: np.uint64) -> np.ndarray:
        return np.flatnonzero(self.opens & (self.name == name))

    def _rows(self) -> tuple[np.ndarray, np.ndarray]:
        """Header and cell of the rows that have both."""
        rows = self._named(_TR)
        inside = []
        for name in (_TH, _TD):
            cells = np.append(self._named(name), len(self.begin))
            inside.append(cells[np.searchsorted(cells[:-1], rows, "right")])
        both = (inside[0] < self.partner[rows]) & (inside[1] < self.partner[rows])
        return inside[0][both], inside[1][both]

    def _prices(self) -> np.ndarray:
        """The price node of the pages that have one."""
        nodes = self._named(_BDI)
        if not len(nodes):
            return nodes
        classed = np.flatnonzero(self.opens & (self.attributes < self.end))
        texts, code = self._distinct(self.attributes[classed], self.end[classed])
        classes = [_classes(text) for text in texts]
        of_price, of_amount = (np.array([name in c for c in classes], bool)[code] for name in ("price", "amount"))

        def around(elements: np.ndarray) -> np.ndarray:
            """How many of the elements are open before each tag."""
            change = np.zeros(len(self.begin) + 1, np.int64)
            change[elements + 1] += 1
            change[self.partner[elements]] -= 1
            return np.cumsum(change)[:-1]

        amounts = classed[of_amount]
        below = amounts[around(classed[of_price])[amounts] > 0]
        nodes = nodes[around(below)[nodes] > 0]
        return nodes[np.unique(self.page[nodes], return_index=True)[1]]

    def _collect(self, heads: np.ndarray, cells: np.ndarray, prices: np.ndarray) -> tuple[pa.Array, pa.Array]:
        opens = np.concatenate([heads, cells, prices])
        ends = self.partner[opens]
        # What hides between two texts may have to join them first.
        odd = np.concatenate([[0], np.cumsum(self.nameless)])
        self.whole[self.page[opens[odd[ends] > odd[opens]]]] = False
        texts, code = self._texts(opens, ends)
        places: dict[str, int] = {}
        a, b = len(heads), len(heads) + len(cells)
        label_of = np.zeros(len(texts), np.int64)
        for label in np.flatnonzero(np.bincount(code[:a], minlength=len(texts))).tolist():
            label_of[label] = places.setdefault(texts[label].lower(), len(places))
        used = self.whole[self.page[heads]]
        page, label, value = self.page[heads][used], label_of[code[:a][used]], code[a:b][used]
        price = np.full(self.n, len(texts), np.int64)
        texts.append("0")
        of_price = self.page[prices]
        price[of_price] = code[b:]

        others = []
        for other in np.flatnonzero(~self.whole).tolist():
            specs, text = read_page(self.held[self.first[other]: self.first[other + 1]].decode())
            price[other] = len(texts)
            texts.append(text)
            for name, held in specs.items():
                others.append((other, places.setdefault(name, len(places)), len(texts)))
                texts.append(held)
        if others:
            more = np.array(others, np.int64).T
            page, label, value = (np.concatenate(pair) for pair in zip((page, label, value), more, strict=True))
            order = np.argsort(page, kind="stable")
            page, label, value = page[order], label[order], value[order]
        # Of a repeated label the first place and the last value stay.
        key = page * max(1, len(places)) + label
        first = np.unique(key, return_index=True)[1]
        last = len(key) - 1 - np.unique(key[::-1], return_index=True)[1]
        order = np.argsort(first)
        first, value = first[order], value[last[order]]
        begins = np.searchsorted(page[first], np.arange(self.n + 1)).astype(np.int32)
        held = pa.array(texts, pa.string())
        specs = pa.MapArray.from_arrays(
            pa.array(begins), pa.array(list(places), pa.string()).take(pa.array(label[first])),
            held.take(pa.array(value)))
        return specs, held.take(pa.array(price))

    def _distinct(self, start: np.ndarray, stop: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The distinct ones of some stretches of text, and which one each is."""
        size = stop - start
        at = np.concatenate([[0], np.cumsum(size)])
        body = self.data[np.repeat(start - at[:-1], size) + np.arange(at[-1])]
        held = pa.StringArray.from_buffers(
            len(size), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(body)).dictionary_encode()
        return held.dictionary.to_pylist(), held.indices.to_numpy(zero_copy_only=False)

    def _texts(self, opens: np.ndarray, ends: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The texts of elements, and which one each has."""
        pieces = ends - opens
        at = np.cumsum(pieces) - pieces
        tag = np.repeat(opens - at, pieces) + np.arange(int(pieces.sum()))
        found, piece = self._distinct(self.end[tag] + 1, self.begin[tag + 1])
        decoded = [unescape(t) if "&" in t else t for t in found]
        texts = [t.strip() for t in decoded]
        code = piece[at].astype(np.int64)
        several = np.flatnonzero(pieces > 1)
        code[several] = len(texts) + np.arange(len(several))
        parts = [decoded[i] for i in piece.tolist()] if len(several) else []
        for a, n in zip(at[several].tolist(), pieces[several].tolist()):
            texts.append("".join(parts[a: a + n]).strip())
        return texts, code
