"""Class-scoped HTML blocks via ``mapInPandas`` (the one Python path).

Regexes cannot follow nesting (``<div class="x"><div>..</div>..</div>``)
and ``xpath`` needs well-formed XML, which crawled pages are not. This
walker runs the standard-library ``html.parser`` over each page inside the
executors, Arrow batch by batch, and emits one row per matching element:
``(id, block, pos, text, attr)``. Pages are repartitioned before the walk
(so one large file does not make one large task) and html is dropped right
after it.
"""
from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "wbr"}
OUT_SCHEMA = "id LONG, block STRING, pos INT, text STRING, attr STRING"


class _Walker(HTMLParser):
    def __init__(self, specs):
        super().__init__(convert_charrefs=False)   # keep entities as written
        self.specs = specs          # [(block, tag, cls, attr_name)]
        self.stack = []             # open tags: (tag, [spec indexes opened here])
        self.open = {}              # spec index -> [text parts, attr]
        self.found = []             # (block, text, attr) in document order
        self.order = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        opened = []
        for i, (block, t, cls, attr_name) in enumerate(self.specs):
            if tag == t and (cls is None or cls in classes) and i not in self.open:
                self.open[i] = [[], a.get(attr_name) if attr_name else None]
                opened.append(i)
                self.order.append(i)
        if tag not in VOID:
            self.stack.append((tag, opened))
        else:
            for i in opened:
                self._close(i)

    def handle_endtag(self, tag):
        # pop to the matching open tag (tolerates unclosed children)
        for j in range(len(self.stack) - 1, -1, -1):
            if self.stack[j][0] == tag:
                for _, opened in self.stack[j:]:
                    for i in opened:
                        self._close(i)
                del self.stack[j:]
                return

    def handle_data(self, data):
        for parts, _ in self.open.values():
            parts.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")

    def _close(self, i):
        parts, attr = self.open.pop(i)
        self.found.append((self.specs[i][0], "".join(parts), attr))

    def finish(self):
        for i in list(self.open):
            self._close(i)
        return self.found


def _walk(specs):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for pid, html in zip(b["id"].tolist(), b["html"].tolist()):
                w = _Walker(specs)
                try:
                    w.feed(html or "")
                    w.close()
                except AssertionError:  # the parser's answer to a broken declaration: keep what was found
                    pass
                counters = {}
                for block, text, attr in w.finish():
                    n = counters.get(block, 0)
                    counters[block] = n + 1
                    rows.append((pid, block, n, text, attr))
            yield pd.DataFrame(rows, columns=["id", "block", "pos", "text", "attr"])
    return run


def html_blocks(pages: DataFrame, specs: list[tuple[str, str, str | None, str | None]],
                id_col: str = "page_id", html_col: str = "html", partitions: int | None = None) -> DataFrame:
    """``specs``: (block name, tag, class or None, attribute or None).
    Returns (id, block, pos, text, attr) per matching element."""
    p = pages.select(pages[id_col].cast("long").alias("id"), pages[html_col].alias("html"))
    p = p.repartition(partitions, "id") if partitions else p
    return p.mapInPandas(_walk(specs), OUT_SCHEMA)
