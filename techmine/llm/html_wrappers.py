"""Main text of web pages by wrappers inferred per host.

A page's markup becomes a stream of structural tags and texts (inline tags are
transparent, missing end tags are implied).  A wrapper is a union-free regular
expression over such streams: tags with, for each, whether it is optional or
repeated, groups of tags that repeat together, and texts that are constant on
all pages or free slots.  Wrappers start as the first page of a host and are
aligned with one page after the other: texts that differ become slots, runs and
tandem sequences become repeated groups, tags on one side only become optional.

Hosts can hold any share of the pages.  Every task folds the pages it reads
into partial wrappers, whose size does not depend on the number of pages; the
partial wrappers of a host are aligned with each other in two rounds, first by
salted parts and then by host.

A page is then aligned with its host's wrapper, and a text goes only if it equals the
constant in its place.  Which kind of container holds the articles of a host is
decided over all its pages, by the text that each kind holds; there constants go
that stand in boxes of their own, not those of the container itself or of paragraphs,
headings, lists and tables: an article may open like all others of its host.  Texts that only some pages have are kept,
so a host with one page of another kind keeps its template texts there.

Defined results: null html gives the empty text; a null or odd url belongs to
the host ''; repeated rows give equal results; an empty table gives an empty
result.  Other columns pass through ``extracted`` untouched.
"""

from __future__ import annotations

import html as html_lib
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from techmine.llm.common import partitions, prepare, small_side, stored

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template annotation annotation-xml".split())
BLOCKS = frozenset("""html head body header nav footer aside article main section div p h1 h2 h3 h4 h5 h6 ul ol li
dl dt dd table thead tbody tfoot tr td th caption form fieldset figure figcaption blockquote pre address details
summary dialog menu center hgroup search select option optgroup button legend""".split())
# An opening tag that ends an open element of these, up to the nearest scope.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "thead": ("tbody", "tfoot", "tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
        "tfoot": ("thead", "tbody", "tr", "td", "th"), "option": ("option",), "optgroup": ("option", "optgroup"),
        "body": ("head",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "optgroup": ("select",)}
KEEPS_P = frozenset(("option", "optgroup", "button", "select", "legend"))

# Containers that never hold article text, by tag, role and words of class or id.
APART = frozenset("""head nav header footer aside form button select menu dialog fieldset search legend""".split())
APART_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
APART_WORDS = frozenset("""ad ads adbox adslot adunit adsense advert adverts advertisement advertising sponsor sponsored
promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar sidenav footer header masthead topbar
cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription
signup login paywall comment comments disqus reply replies respond share sharing social related recommended
recommendations teaser teasers widget widgets toolbar pagination pager copyright""".split())
# Those that also occur in names of article parts (market-share, related-work), and
# the words that may stand beside them in the name of a part that is not.
COMMON_WORDS = frozenset("""promotion navigation menu footer header notice notices alert popup modal overlay signup login
subscription reply replies respond share sharing social related recommended recommendations widget widgets toolbar
copyright banner""".split())
BESIDE = frozenset("""area article articles bar block bottom box button buttons center container content cookies desktop email
end flex float global grid group holder icon icons info inline inner item items layer layout left link links list main
mid middle mobile more news outer page panel posts primary reader right row secondary section site slot sticky stories
story strip tools top unit user wrap wrapper you""".split())
# Elements that carry article text themselves; their ids name what is written there.
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6".split())
# In a container of articles, texts in these stay even where all pages have them.
CARRIES = TEXTUAL | frozenset("li dt dd th td caption figcaption blockquote pre details summary".split())
NOT_A_PART = ("has-", "with-", "no-", "is-", "hide-", "show-")
# Containers of articles, best first: by tag or role, then by class or id.
ARTICLE_WORDS = frozenset("""article article-body article-content articlebody post post-body post-content entry
entry-content story story-body content main main-content""".split())
WHOLE = frozenset(("html", "body", "article", "main"))
TEASERS = frozenset(("teaser", "related", "promo", "comment", "comments", "ad", "sponsored"))

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|"""
                   r"""<[!?][^>]*>|<[/a-zA-Z!?][^>]*\Z""", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""",
                       re.IGNORECASE)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

def _strength(tag: str, classes: set[str], ids: set[str]) -> str:
    """``x`` for a part apart from the article wherever it stands, ``y`` for one
    that is apart only outside an article, else ''."""
    found = ""
    for name, is_id in [(n, False) for n in classes] + [(n, True) for n in ids]:
        if name.startswith(NOT_A_PART):
            continue
        words = {w for w in name.split("-") if w and not any(c.isdigit() for c in w)}
        hit = words & APART_WORDS or {name.replace("-", "")} & APART_WORDS
        if not hit:
            continue
        if tag not in BLOCKS or tag in TEXTUAL:  # only a class that says nothing else
            sure = not is_id and len(words) == 1 and (tag in BLOCKS or not hit <= COMMON_WORDS)
        elif hit <= COMMON_WORDS:
            sure = words <= APART_WORDS | BESIDE and not (is_id and tag == "section")
        else:
            sure = True
        if sure:
            return "x"
        found = "y" if tag in BLOCKS and tag not in TEXTUAL else found
    return found


@lru_cache(maxsize=8192)
def _label(tag: str, attributes: str) -> str:
    """Tag with its part: ``!x`` apart from the article (``!y``: but not when inside
    one), ``!1`` to ``!3`` a container of articles, best first."""
    classes: set[str] = set()
    ids: set[str] = set()
    role, special = "", ""
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            (classes if name == "class" else ids).update(CAMEL.sub("-", value).lower().replace("_", "-").split())
        elif name == "role":
            role = value.lower()
        elif name == "itemprop":
            special = special or ("1" if value.lower() == "articlebody" else "")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (
                name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE)):
            return f"{tag}!x"
    apart = ""
    if tag not in ("html", "body"):
        if (tag in APART or role in APART_ROLES) and tag not in WHOLE:
            return f"{tag}!x"
        # The classes of a whole page say what it has, those of an article what it is.
        apart = _strength(tag, classes, ids) if tag not in WHOLE else "x" if tag == "article" and classes & TEASERS else ""
        if apart == "x":
            return f"{tag}!x"
    if tag == "article" or role == "article" or special:
        return f"{tag}!1"
    if tag == "main" or role == "main":
        return f"{tag}!2"
    if (classes | ids) & ARTICLE_WORDS and tag in BLOCKS and tag not in WHOLE | TEXTUAL:
        return f"{tag}!3"
    return f"{tag}!y" if apart else tag


TEXT, GROUP = "#", "()"
CONTAINERS = ("!1", "!2", "!3")


# A node is [label, kids]; the kids of a TEXT node are its pieces.
def parse(page: str) -> list:
    """Tree of the structural elements of a page, of any depth; every text is kept
    (references decoded, adjacent texts as one) but those of raw elements such as
    scripts."""
    root: list = ["", []]
    stack, tags = [root], [""]
    at = 0
    end = len(page)

    def close(k: int) -> None:
        del stack[k:], tags[k:]

    def write(text: str) -> None:
        kids = stack[-1][1]
        if kids and type(kids[-1]) is list and kids[-1][0] == TEXT:
            kids[-1][1].append(text)
        else:
            kids.append([TEXT, [text]])

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            write(html_lib.unescape(page[at:]))
            break
        if m.start() > at:
            write(html_lib.unescape(page[at:m.start()]))
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCKS or tag in tags:
                for k in range(len(tags) - 1, 0, -1):
                    if tags[k] == tag:
                        close(k)
                        break
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            if not m[3].endswith("/"):
                at = closing.end() if closing else end
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                write(" ")
            continue
        if tag in BLOCKS:
            if tag not in KEEPS_P and "p" in tags:
                close(len(tags) - 1 - tags[::-1].index("p"))
            ends = ENDS.get(tag)
            if ends:
                scope = SCOPES.get(tag, ("table",))
                for k in range(len(tags) - 1, 0, -1):
                    if tags[k] in scope:
                        break
                    if tags[k] in ends:
                        close(k)
                        if tag != "tr" and tag[0] != "t":
                            break
            label = _label(tag, m[3])
        else:
            label = _label(tag, m[3]) if m[3] else tag
            if not label.endswith("!x"):
                continue  # inline markup is transparent
        if "form" in tags and (tag in ("nav", "footer") or label[-2:] in CONTAINERS):
            for above in stack:  # a form around the whole page, not in it
                if above[0] == "form!x":
                    above[0] = "form"
        node = [label, []]
        stack[-1][1].append(node)
        stack.append(node)
        tags.append(tag)
    return root


# An expression is a tuple of items (label, repeated, optional, constant,
# items).  ``constant`` is the checksum of a text that is the same on all pages,
# None for a slot.  Levels below MAX_DEPTH are left out of expressions; their texts
# count as slots.
MAX_DEPTH = 48
MAX_ITEMS = 40
KEPT_ENDS = 12
MAX_PERIOD = 4


def _is_apart(label: str) -> bool:
    return label.endswith(("!x", "!y"))


def _checksum(node: list) -> int | None:
    text = " ".join("".join(node[1]).split())
    return zlib.crc32(text.encode("utf-8", "replace")) if text else None


def _item(node: list, depth: int = 0) -> tuple | None:
    """The item of one element or text; None for white space."""
    if node[0] == TEXT:
        constant = _checksum(node)
        return None if constant is None else (TEXT, False, False, constant, ())
    # What is inside a part apart from the article needs no structure.
    if _is_apart(node[0]):
        return (node[0], False, False, None, ())
    if depth == MAX_DEPTH:
        return (node[0], False, False, None, ((TEXT, True, True, None, ()),))
    return (node[0], False, False, None, expression(node[1], depth + 1))


def expression(kids: list, depth: int = 0) -> tuple:
    """The expression of one page's kids."""
    return _folded([it for kid in kids if (it := _item(kid, depth)) is not None])


def _merged(a: tuple, b: tuple) -> tuple:
    if a == b:
        return a
    return (a[0], a[1] or b[1], a[2] or b[2], a[3] if a[3] == b[3] else None, aligned(a[4], b[4]))


def _in_one(a: tuple, b: tuple) -> tuple:
    """Two neighbours as one repeated item."""
    one = _merged(a, b)
    return (one[0], one[0] != TEXT, a[2] and b[2], *one[3:])


def _fixed(it: tuple) -> bool:
    return not it[2] and not _has_slot((it,))


def _folded(items: list[tuple]) -> tuple:
    """Neighbours of one label as one repeated item, unless one of them has the same
    texts on all pages and the other has not; tandem sequences as repeated groups.
    Of long lists the ends are kept, what is between becomes one repeated group of
    all its labels as options."""
    out: list[tuple] = []
    for it in items:
        if out and out[-1][0] == it[0] and (out[-1][3:] == it[3:] or not (_fixed(out[-1]) or _fixed(it))):
            out[-1] = _in_one(out[-1], it)
        else:
            out.append(it)
    period = 2
    while period <= MAX_PERIOD:
        labels = [it[0] for it in out]
        at = next((i for i in range(len(out) - 2 * period + 1)
                   if labels[i:i + period] == labels[i + period:i + 2 * period] and GROUP not in labels[i:i + period]
                   and len(set(labels[i:i + period])) > 1), None)
        if at is None:
            period += 1
            continue
        body, to = tuple(out[at:at + period]), at + period
        while labels[to:to + period] == labels[at:at + period]:
            body = tuple(_merged(x, y) for x, y in zip(body, out[to:to + period], strict=True))
            to += period
        out[at:to] = [(GROUP, True, False, None, body)]
    if len(out) > MAX_ITEMS:
        found: dict[str, tuple] = {}
        for it in _flat(out[KEPT_ENDS:-KEPT_ENDS]):
            found[it[0]] = _merged(found[it[0]], it) if it[0] in found else it
        options = tuple((it[0], it[1] or it[0] != TEXT, True, *it[3:]) for it in found.values())
        group = options[0] if len(options) == 1 else (GROUP, True, True, None, options)
        return (*out[:KEPT_ENDS], group, *out[-KEPT_ENDS:])
    return tuple(out)


def _flat(items) -> Iterator[tuple]:
    for it in items:
        if it[0] == GROUP:
            yield from _flat(it[4])
        else:
            yield it


def _with_groups(items: tuple, other: tuple) -> list[tuple]:
    """``items`` with sequences that are groups in ``other`` made groups too."""
    out = list(items)
    for g in other:
        if g[0] != GROUP or all(it[2] for it in g[4]):  # options have no order
            continue
        want = [it[0] for it in g[4]]
        i = 0
        while i + len(want) <= len(out):
            if [it[0] for it in out[i:i + len(want)]] == want:
                out[i:i + len(want)] = [(GROUP, False, False, None, tuple(out[i:i + len(want)]))]
            i += 1
    return out


def _covers(a: tuple, b: tuple) -> bool:
    """Whether aligning ``b`` with ``a`` would leave ``a`` as it is (a quick
    test for streams of the same shape)."""
    if a is b or a == b:
        return True
    if len(a) != len(b):
        return False
    return all(x[0] == y[0] and x[1] >= y[1] and x[2] >= y[2] and (x[3] is None or x[3] == y[3])
               and _covers(x[4], y[4]) for x, y in zip(a, b, strict=True))


def _likeness(x: tuple, y: tuple) -> int:
    return 0 if x[0] != y[0] else 2 if x[3:] == y[3:] else 1


def aligned(a: tuple, b: tuple) -> tuple:
    """The expression of all streams of both: common items by a longest common
    subsequence of labels, in which equal items count twice; the others optional."""
    if _covers(a, b):
        return a
    x, y = _with_groups(a, b), _with_groups(b, a)
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + _likeness(x[i], y[j]))
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and x[i][0] == y[j][0] and best[i][j] == best[i + 1][j + 1] + _likeness(x[i], y[j]):
            out.append(_merged(x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append((*x[i][:2], True, *x[i][3:]))
            i += 1
        else:
            out.append((*y[j][:2], True, *y[j][3:]))
            j += 1
    return _folded(out)


def _packed(items: tuple) -> list:
    return [[it[0], int(it[1]), int(it[2]), it[3], _packed(it[4])] for it in items]


def to_text(items: tuple) -> str:
    return json.dumps(_packed(items), separators=(",", ":"))


def _unpacked(items: list) -> tuple:
    return tuple((it[0], bool(it[1]), bool(it[2]), it[3], _unpacked(it[4])) for it in items)


@lru_cache(maxsize=4096)
def from_text(text: str) -> tuple:
    return _unpacked(json.loads(text))


def _has_slot(items) -> bool:
    return any((it[0] == TEXT and it[3] is None) or _has_slot(it[4]) for it in _flat(items) if not _is_apart(it[0]))


@lru_cache(maxsize=4096)
def _plan(wrapper: str) -> tuple[tuple, bool]:
    """The expression, and whether pages of the host differ in some text."""
    items = from_text(wrapper)
    return items, _has_slot(items)


def masses(root: list) -> list[int]:
    """Characters of text in the containers of each kind."""
    out, stack = [0, 0, 0], [(root, frozenset())]
    while stack:
        node, kinds = stack.pop()
        for kid in node[1]:
            if kid[0] == TEXT:
                if kinds:
                    n = sum(len(t.strip()) for t in kid[1])
                    for k in kinds:
                        out[k] += n
            elif not kid[0].endswith("!x") and (kinds or not kid[0].endswith("!y")):
                stack.append((kid, kinds | {int(kid[0][-1]) - 1} if kid[0][-2:] in CONTAINERS else kinds))
    return out


def _kind(mass) -> str | None:
    """The best kind that holds at least half the text of the fullest one."""
    return next((str(k + 1) for k in range(3) if mass[k] and 2 * mass[k] >= max(mass)), None)


def _places(kids: list, items: list[tuple | None], flat: list[tuple], groups: dict[str, tuple]) -> list[tuple | None]:
    """The item of the wrapper in whose place each kid stands, None without one."""
    n, m = len(kids), len(flat)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        if items[i] is None:
            best[i] = best[i + 1]
            continue
        for j in range(m - 1, -1, -1):
            like = _likeness(items[i], flat[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1],
                             like and best[i + 1][j if flat[j][1] else j + 1] + like)
    out: list[tuple | None] = []
    j = 0
    for i in range(n):
        found = None
        if items[i] is not None:
            while j < m and best[i][j] == best[i][j + 1]:
                j += 1
            if j < m and best[i][j] != best[i + 1][j]:
                found = flat[j]
                j += not found[1]
            else:
                found = groups.get(items[i][0])
        out.append(found)
    return out


def _emit(root: list, items: tuple, kind: str | None, template: bool) -> str:
    """The text of the article, read along the wrapper if ``template``.  With ``kind`` it
    is that inside containers of this kind, else the whole page.  Texts are ``carried``
    by a container (1: those directly in it) or an element of an article (2: all)."""
    out: list[str] = []
    stack: list = [(root, items, kind is None, 0, 0)]
    while stack:
        top = stack.pop()
        if type(top) is str:
            out.append(top)
            continue
        node, wrapper, inside, depth, carried = top
        kids = node[1]
        places: list = [None] * len(kids)
        if template and wrapper and depth <= MAX_DEPTH:
            own = [_item(kid, depth) for kid in kids]
            flat = list(_flat(wrapper))
            groups = {it[0]: it for g in wrapper if g[0] == GROUP for it in _flat(g[4])}
            places = _places(kids, own, flat, groups)
        todo: list = []
        for kid, place in zip(kids, places, strict=True):
            if kid[0] == TEXT:
                # A text of the template is on all pages, and this page has it too.
                if inside and (carried or not (
                        place and not place[2] and place[3] is not None and place[3] == _checksum(kid))):
                    todo.append("".join(kid[1]))
            elif not kid[0].endswith("!x") and not (kid[0].endswith("!y") and (kind is None or not inside)):
                tag, _, part = kid[0].partition("!")
                here = (kid, place[4] if place and not place[2] else (), inside or part == kind, depth + 1,
                        2 if carried == 2 or (kind and inside and tag in CARRIES) else int(part == kind))
                todo.extend((" ", here, " ") if tag in BLOCKS else (here,))
        stack.extend(reversed(todo))
    return " ".join("".join(out).split())


def main_text(page: str | None, wrapper: str | None, kind: str | None = None) -> str:
    """Main text of one page, aligned with the wrapper of its host, from the host's kind
    of container; a page without one of this kind is judged by its own."""
    if not page:
        return ""
    root = parse(page)
    items, differs = _plan(wrapper or "[]")
    mass = masses(root)
    if kind is None or not mass[int(kind) - 1]:
        kind = _kind(mass)
    return _emit(root, items, kind, differs)


# Hosts whose partial wrappers a task holds at once.
HELD_HOSTS = 2000
SALTS = 16
WRAPPERS = "host string, wrapper string, in_1 long, in_2 long, in_3 long"
NAMES = ["host", "wrapper", "in_1", "in_2", "in_3"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 2 + [pa.int64()] * 3,
                                                                      strict=True)], NAMES)


def _packed_rows(found: dict[str, list]) -> pa.RecordBatch:
    return _batch([(host, to_text(w), *mass) for host, (w, mass) in found.items()])


def _fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[str, list] = {}
    for b in batches:
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            root = parse(page)
            one, mass = expression(root[1]), masses(root)
            if not one:  # an empty page says nothing about the others
                continue
            if host in found:
                held = found[host]
                found[host] = [aligned(held[0], one), [x + y for x, y in zip(held[1], mass, strict=True)]]
            else:
                found[host] = [one, mass]
        if len(found) > HELD_HOSTS:
            yield _packed_rows(found)
            found = {}
    if found:
        yield _packed_rows(found)


def _fold_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by host and salt: one wrapper is held at a time."""
    key, held, total = None, (), [0, 0, 0]
    for b in batches:
        done: list[tuple] = []
        for host, salt, text, *mass in zip(*[c.to_pylist() for c in b.columns], strict=True):
            if key == (host, salt):
                held = aligned(held, from_text(text))
                total = [x + y for x, y in zip(total, mass, strict=True)]
                continue
            if key is not None:
                done.append((key[0], to_text(held), *total))
            key, held, total = (host, salt), from_text(text), mass
        if done:
            yield _batch(done)
    if key is not None:
        yield _batch([(key[0], to_text(held), *total)])


def host_of(url: str):
    """Lower-case host of an absolute url, else ''."""
    return F.lower(F.coalesce(F.regexp_extract(
        F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper, kind): the wrapper of every host and the kind of container that
    holds its articles, over all its pages."""
    spark = prepare(pages.sparkSession)
    n = partitions(spark)
    rows = pages.where(F.col(html).isNotNull()).select(host_of(url).alias("host"), F.col(html).alias("html"))
    sums = [F.sum(c).alias(c) for c in NAMES[2:]]
    partial = rows.mapInArrow(_fold_pages, WRAPPERS).groupBy("host", "wrapper").agg(*sums)
    for salts in (SALTS, 1):
        salt = F.pmod(F.xxhash64("wrapper"), F.lit(salts)).cast("int").alias("salt")
        partial = (partial.select("host", salt, *NAMES[1:]).repartition(n, "host", "salt")
                          .sortWithinPartitions("host", "salt", "wrapper").mapInArrow(_fold_wrappers, WRAPPERS))
    most = F.greatest(*NAMES[2:])
    kind = F.coalesce(*[F.when((F.col(f"in_{k}") > 0) & (2 * F.col(f"in_{k}") >= most), F.lit(str(k))) for k in (1, 2, 3)])
    return partial.select("host", "wrapper", kind.alias("kind"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(*r) for r in zip(*[c.to_pylist() for c in b.columns[-3:]], strict=True)]
        yield pa.RecordBatch.from_arrays([*b.columns[:-3], pa.array(texts, pa.string())],
                                         [*b.schema.names[:-3], "__llm_text"])


def extracted(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The columns of ``pages`` but the html, and the main text as ``__llm_text``.

    Wrappers meet their pages without moving these while the wrappers are proven
    small; beyond that by a join that AQE splits at hot hosts.
    """
    prepare(pages.sparkSession)
    wrappers = stored(infer_wrappers(pages, url, html), "wrappers")
    wrappers = small_side(wrappers.select(F.col("host").alias("__llm_key"), F.col("wrapper").alias("__llm_wrapper"),
                                          F.col("kind").alias("__llm_kind")))
    carry = [c for c in pages.columns if c != html]
    joined = pages.select(*carry, host_of(url).alias("__llm_host"), F.col(html).alias("__llm_html")).join(
        wrappers, F.col("__llm_host") == F.col("__llm_key"), "left")
    rows = joined.select(*[F.col(c) for c in carry], "__llm_html", "__llm_wrapper", "__llm_kind")
    schema = pages.select(*carry).schema.add("__llm_text", "string")
    return rows.mapInArrow(_extract, schema)
