"""HTML extraction (SC17-SC19) as one Arrow ``mapInPandas`` pass per page.

Spark has no HTML parser, so each page is parsed once, inside the task that
holds it, with the standard library's ``html.parser``; the pass returns every
extraction the resolver needs, and everything after it (gates, link choice,
joins) is native Spark.

Per page it returns:
  visible_text  all text nodes (entities unescaped, title kept; comments,
                script, style and ruby annotations left out), adjacent text
                as one piece, each trimmed, empties dropped,
                joined by one space
  viewer_text   text of the elements matched by the selector list
                ``[class*="textLayer"], [id*="textLayer"] div, span``
                in document order, joined by one space; null when nothing
                matches (a match whose text is empty still counts)
  links         every ``a[href]`` value in document order
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.functions.strict import resolve_url
from techmine.functions.text import is_pdf_link

# Elements without end tags, and elements whose text is not shown.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
HIDDEN = {"script", "style", "template", "rt", "rp"}
VIEWER_MARK = "textLayer"


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = []        # open elements: [tag, matched, pieces, under_viewer_id]
        self.visible = []
        self.matches = []      # pieces lists of matched elements, document order
        self.links = []
        self.hidden = 0
        self.data = []         # data events since the last tag or comment

    def flush(self):
        """Adjacent data events (a stray ``<`` ends one) are one text."""
        piece = "".join(self.data).strip()
        self.data = []
        if self.hidden or not piece:
            return
        self.visible.append(piece)
        for e in self.stack:
            if e[1]:
                e[2].append(piece)

    def handle_comment(self, data):
        self.flush()

    def handle_starttag(self, tag, attrs):
        self.flush()
        a = {k: (v if v is not None else "") for k, v in attrs}
        if tag == "a" and "href" in a:
            self.links.append(a["href"])
        under_id = any(e[3] or VIEWER_MARK in e[4] for e in self.stack)
        matched = (VIEWER_MARK in a.get("class", "")) or (tag == "div" and under_id) or tag == "span"
        pieces = [] if matched else None
        if matched:
            self.matches.append(pieces)
        if tag in VOID:
            return
        self.stack.append([tag, matched, pieces, under_id, a.get("id", "")])
        if tag in HIDDEN:
            self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                for e in self.stack[i:]:
                    if e[0] in HIDDEN:
                        self.hidden -= 1
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.data.append(data)


def parse_page(html: str | None):
    if html is None:
        return None, None, []
    p = _Page()
    try:
        p.feed(html)
        p.close()
        p.flush()
    except Exception:
        pass
    viewer = " ".join(" ".join(m) for m in p.matches) if p.matches else None
    return " ".join(p.visible), viewer, p.links


HTML_SCHEMA = "visible_text string, viewer_text string, links array<string>"


def extract_html(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """SC17 + SC18 + SC19 in one pass: ``keep`` columns plus the three extractions."""
    from techmine.operators.joins import ensure_parallelism
    keep = keep or [c for c in pages.columns if c != html_col]
    src = ensure_parallelism(pages.select(*keep, html_col))
    schema_keep = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields
                            if f.name in keep)

    def run(batches):
        for pdf in batches:
            parsed = [parse_page(h) for h in pdf[html_col]]
            out = pdf[keep].copy()
            out["visible_text"] = [r[0] for r in parsed]
            out["viewer_text"] = [r[1] for r in parsed]
            out["links"] = [r[2] for r in parsed]
            yield out

    return src.mapInPandas(run, f"{schema_keep}, {HTML_SCHEMA}")


def first_pdf_link(links_col="links", base_col="url"):
    """SC19 + SC13: the first ``.pdf`` link (case-sensitive suffix), resolved
    against the page URL."""
    first = F.get(F.filter(F.col(links_col), is_pdf_link), 0)
    return F.when(first.isNotNull(), resolve_url(F.col(base_col), first))
