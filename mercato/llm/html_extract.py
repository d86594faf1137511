"""HTML main-text extraction with wrappers inferred from same-host pages.

A wrapper is a union-free regular expression over a host's pages: elements, text
slots, optional and repeated groups, no alternatives. It is inferred by aligning
pages one after the other: neighbours of one kind become a repeated group, what only
one side has becomes optional, texts that differ become a slot. Alignment is
associative enough to be done in any grouping, so every task first folds its own
pages of a host into one partial wrapper, partial wrappers meet by (host, share) and
then by host; a host with a third of all pages arrives as a few rows per task.

The wrapper decides once per host which part is the article: its ``article`` (else
``main``) elements, or, where a host has neither, the element that holds most of the
varying text outside links. Menus, headers, footers, sidebars, notices, adverts,
forms and comments are known by element or by a whole class, id or role token, and left
out: on layout elements by any such word; on text elements (paragraphs, tables, list
items, inline elements) only by a class that says advert, notice, sidebar or
navigation; headings, ``html``, ``body`` and ``main`` never, ids of sections neither. An
``article`` named so is left out only where the host has another one; what holds the
article stays. A layout element with such a word inside a longer token ("cookie-notice")
is judged by the wrapper: it goes if it is on every page of a host whose pages differ in
their plain text, and constant or mostly links. The pages are then read along the wrapper of their host.

Defined results: null html gives an empty text, a null or odd url the host ''. A page
without the host's article element is judged by its own text. Blocks are texts between
block elements; white space in a block becomes one space; blocks are joined by an empty
line; nothing else is dropped (captions, addresses, formulas and the text shown for an
object, audio, video or canvas are kept). Broken markup (unclosed or stray tags) is read as
browsers do for paragraphs and lists; scripts, styles, text areas and titles run to their
end tag or the end of the page, and of an embedded element (a button, say) that is not
closed before its parent only the tag is left out. Repeated rows are extracted each. Extra columns
are ignored.
"""

from __future__ import annotations

import html as _html
import json
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import texts_of

DEEPEST = 200           # texts of elements nested deeper are filed under an ancestor
SHARES = 16             # partial wrappers of a host meet in this many groups first

# fixed values: HTML element kinds and the words that name page furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var".split())
# elements whose content is text up to their own end tag, or the end of the page
RAW = ("script", "style", "textarea", "title")
# inline elements left out with their content, if their end tag comes before their parent's
EMBEDDED = frozenset("noscript template iframe svg select button".split())
# inline elements whose texts are kept, set off by spaces: formulas and the text shown for
# what cannot be played
SPACED = frozenset(
    "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose "
    "msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd mlabeledtr "
    "none maction semantics annotation annotation-xml object canvas audio video".split())
FURNITURE = frozenset(
    "nav header footer aside form menu dialog head fieldset datalist".split())
WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget "
    "notice notices cookie cookies consent alert popup modal overlay newsletter subscribe signup "
    "login share sharing social related recommended comment comments commentlist reply replies respond "
    "discussion disqus pagination pager toolbar skip".split())
# words an article uses for its own sections too: never sure by themselves
AMBIGUOUS = frozenset("related recommended discussion reply replies respond".split())
# what the parts of a compound name (comment-list, ad-slot, sidebar-left) say, and the parts that
# may stand beside them
COMPOUND = tuple((frozenset(own.split()), frozenset(beside.split())) for own, beside in (
    ("comment comments commentlist disqus", "list area section thread threads box body item items block reader "
     "readers user users post page main content entry count title"),
    ("ad ads adv advert adverts advertisement", "slot unit block banner space zone area placement leaderboard "
     "top bottom left right inner label google rail sticky mobile desktop box"),
    ("sidebar", "left right main primary secondary inner area content widget widgets sticky page site blog")))
LAYOUT = frozenset("wrap wrapper container row col column md lg sm xs fluid flex grid clearfix div".split())
# words that say furniture of text and inline elements too
STRONG = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation "
    "breadcrumb breadcrumbs sidebar aside notice notices cookie cookies consent alert popup modal "
    "overlay pagination pager toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
TEXTUAL = frozenset(
    "p pre blockquote table caption thead tbody tfoot tr td th li dl dt dd figure figcaption "
    "address".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
HOLDERS = frozenset("ul ol dl table tbody thead article section div body main td".split())

FOREIGN = ("svg", "math")       # '/>' closes these and what is in them

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    rf"|<({'|'.join(RAW)})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>?"
    r"|([^<]+|<)", re.S | re.I)
_EMBEDDED = re.compile(rf"<(?:{'|'.join(sorted(EMBEDDED))})(?=[\s/>])", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPLIT = re.compile(r"[^a-z]+")

# how sure it is that an element is page furniture
PLAIN, HINTED, NAMED, ALWAYS = range(4)


def _level(name: str, values: dict[str, str]) -> int:
    if name in FURNITURE:
        return NAMED if name == "form" else ALWAYS
    if name in TEXTUAL or name in INLINE or name in SPACED:
        return PLAIN if STRONG.isdisjoint(values["class"].split()) else NAMED
    if name in ("html", "body", "main") or name in HEADINGS:
        return PLAIN
    classes = values["class"].split()
    ids = values["id"].split()
    if name == "section" or "section" in classes:     # an article's sections are named by what they say
        ids = [i for i in ids if _compound({w for w in _SPLIT.split(i) if w}) and "comment" in i]
    tokens = [*classes, *ids, *values["role"].split()]
    if not (WORDS - AMBIGUOUS).isdisjoint(tokens):
        return HINTED if name == "article" else NAMED
    parts = (w for t in tokens for w in _SPLIT.split(t))
    return PLAIN if name == "article" or WORDS.isdisjoint(parts) else HINTED


def _compound(words: set[str]) -> bool:
    """Whether words are those of a compound furniture name and of its layout only."""
    words = words - LAYOUT
    return any(words & own and words <= own | beside for own, beside in COMPOUND)


def _kind(name: str, attributes: str) -> tuple[str, int]:
    """What tells an element from its siblings, and its level as page furniture."""
    values = {"class": "", "id": "", "role": ""}
    if attributes.strip():
        for key, value in _ATTRIBUTE.findall(attributes):
            if (key := key.lower()) in values and not values[key]:
                values[key] = value.strip("\"'").lower()
    level = _level(name, values)
    # a page's own identifiers would make every page's elements kinds of their own
    if name == "section" or name in TEXTUAL or name in HEADINGS or any(c.isdigit() for c in values["id"]):
        values["id"] = ""
    words = sorted({w for v in values.values() for w in _SPLIT.split(v) if w})
    return ".".join([name, *words, *([str(level)] if words and level else [])]), level


# A node is [kind, times, furniture, children, text]; kind '#' marks a text. ``times`` is
# '1', '?', '+' or '*'; furniture is a level, also part of the kind. Of a text, children is [characters, characters in links], and
# text is the constant text or None (a slot).
KIND, TIMES, FURNISHED, CHILDREN, TEXT = range(5)


def _embedded(tokens: list[re.Match]) -> dict[int, int]:
    """Token of the start tag -> token of the end tag, of the embedded elements that are
    closed before an element around them is."""
    ends, stack, opened = {}, [], Counter()
    for at, m in enumerate(tokens):
        if m[3] is None:
            continue
        name = m[3].lower()
        if not m[2]:
            foreign = name in FOREIGN or any(opened[f] for f in FOREIGN)
            if name not in VOID and not (foreign and m[4].endswith("/")):
                stack.append((name, at))
                opened[name] += 1
        elif opened[name]:
            while True:
                own, start = stack.pop()
                opened[own] -= 1
                if own == name:
                    break
            if name in EMBEDDED:
                ends[start] = at
    return ends


def parse(page: str) -> list:
    """The tree of block elements of a page; block texts are its leaves."""
    root = ["", "1", PLAIN, [], None]
    stack, parts, linked, in_link = [root], [], 0, False
    # of the open elements (not the root): names, depths in the tree, places by name, holders
    names, depths, opened, holders = [""], [0], defaultdict(list), [0]

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                stack[-1][CHILDREN].append(["#", "1", PLAIN, [len(text), min(linked, len(text))], text])
            parts, linked = [], 0

    def close(upto: int):
        flush()
        for name in reversed(names[upto:]):
            opened[name].pop()
            if name in HOLDERS:
                holders.pop()
        del stack[upto:], names[upto:], depths[upto:]

    tokens, ends, after = _TOKEN.finditer(page), {}, -1
    if _EMBEDDED.search(page):
        tokens = list(tokens)
        ends = _embedded(tokens)
    for at, m in enumerate(tokens):
        if at <= after:
            continue
        name = m[3]
        if name is None:
            if (text := m[5]) is not None:
                text = _html.unescape(text) if "&" in text else text
                parts.append(text)
                linked += len(text) * in_link
            elif m[1]:
                parts.append(" ")
            continue
        name = name.lower()
        if name in EMBEDDED:
            parts.append(" ")
            after = ends.get(at, at)
            continue
        if name in SPACED:
            parts.append(" ")
        if m[2]:
            if name == "a":
                in_link = False
            if opened[name]:
                close(opened[name][-1])
                in_link = False
            elif name not in INLINE and name not in SPACED:
                flush()
            continue
        if name in VOID:
            parts.append(" ")
            if name == "hr":
                flush()
            continue
        if opened["head"] and name != "head":       # what cannot be in a head begins the body
            close(opened["head"][-1])
        kind, furniture = _kind(name, m[4])
        if (name in INLINE or name in SPACED) and furniture < NAMED:
            in_link = in_link or name == "a"
            continue
        flush()
        in_link = False
        if name not in INLINE and name not in SPACED:
            closes = CLOSES.get(name, ()) or (("p",) if names[-1] == "p" else ())
            last = max((opened[c][-1] for c in closes if opened[c]), default=0)
            if last and last >= holders[-1]:
                close(last)
        # a deeper element is open like any other, but its blocks go to the tree's deepest
        # element around it; furniture and articles have nodes of their own there too
        top, depth = stack[-1], depths[-1]
        if depth < DEEPEST or top[FURNISHED] < NAMED and (
                furniture >= NAMED or name in ("article", "main") and depth < DEEPEST + 8):
            node = [kind, "1", furniture, [], None]
            top[CHILDREN].append(node)
            depth += 1
        else:
            node = top
        opened[name].append(len(stack))
        if name in HOLDERS:
            holders.append(len(stack))
        stack.append(node)
        names.append(name)
        depths.append(depth)
    flush()
    return root


def _times(a: str, b: str) -> str:
    many, none = "+" in a + b or "*" in a + b, "?" in a + b or "*" in a + b
    return "*" if many and none else "+" if many else "?" if none else "1"


def _merged(a: list, b: list, times: str) -> list:
    if a[KIND] == "#":
        return ["#", times, PLAIN, [a[3][0] + b[3][0], a[3][1] + b[3][1]],
                a[TEXT] if a[TEXT] == b[TEXT] else None]
    return [a[KIND], times, a[FURNISHED], align(a[CHILDREN], b[CHILDREN]), None]


def _optional(node: list) -> list:
    return [node[KIND], _times(node[TIMES], "?"), *node[2:]]


def folded(nodes: list) -> list:
    """Neighbours of one kind become one repeated group, at every level."""
    out: list = []
    for n in nodes:
        if n[KIND] != "#":
            n = [n[KIND], n[TIMES], n[FURNISHED], folded(n[CHILDREN]), None]
        if out and out[-1][KIND] == n[KIND]:
            out[-1] = _merged(out[-1], n, "*" if "?" in out[-1][TIMES] + n[TIMES] else "+")
            if n[KIND] == "#":
                out[-1][TEXT] = None
        else:
            out.append(n)
    return out


def align(a: list, b: list) -> list:
    """One sequence of groups that both (folded) sequences match."""
    if [n[KIND] for n in a] == [n[KIND] for n in b]:
        return [_merged(x, y, _times(x[TIMES], y[TIMES])) for x, y in zip(a, b)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = (best[i + 1][j + 1] + 1 if a[i][KIND] == b[j][KIND]
                          else max(best[i + 1][j], best[i][j + 1]))
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][KIND] == b[j][KIND]:
            out.append(_merged(a[i], b[j], _times(a[i][TIMES], b[j][TIMES])))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return _joined(out)


def _joined(nodes: list) -> list:
    """Neighbours that an optional group brought together become one group again."""
    out: list = []
    for n in nodes:
        if out and out[-1][KIND] == n[KIND]:
            out[-1] = _merged(out[-1], n, "*" if "?" in out[-1][TIMES] and "?" in n[TIMES] else "+")
        else:
            out.append(n)
    return out


def _weight(node: list, forms: bool = False) -> int:
    """Varying characters outside links and furniture below a node (with ``forms``, also in
    forms that hold blocks of text)."""
    if node[KIND] == "#":
        return node[CHILDREN][0] - node[CHILDREN][1] if node[TEXT] is None else 0
    return sum(_weight(c, forms) for c in node[CHILDREN] if c[FURNISHED] < NAMED or forms and _page_form(c))


def _page_form(node: list) -> bool:
    """A form around headings or paragraphs, as servers put one around a page's content."""
    def blocks(n: list) -> int:
        return sum(1 if c[KIND].partition(".")[0] in ("h1", "h2", "p") else blocks(c)
                   for c in n[CHILDREN] if c[KIND] != "#")

    return node[KIND].partition(".")[0] == "form" and blocks(node) > 1


def _places(node: list, name: str, levels: tuple, through: int = HINTED,
            path: tuple = ()) -> Iterator[tuple]:
    """``(path, node)`` of the outermost elements of a name and of some levels, sought
    in elements up to the level ``through``; paths are of kinds."""
    for c in node[CHILDREN]:
        if c[KIND] != "#":
            own = (*path, c[KIND])
            if c[KIND].partition(".")[0] == name and c[FURNISHED] in levels:
                yield own, c
            elif c[FURNISHED] <= through:
                yield from _places(c, name, levels, through, own)


def main_places(wrapper: list) -> list[tuple]:
    """Paths of the elements that hold the article."""
    either = (PLAIN, HINTED)
    for name, levels, through in (("article", (PLAIN,), HINTED), ("main", either, HINTED),
                                  ("article", either, HINTED), ("main", either, NAMED)):
        if found := dict(_places(wrapper, name, levels, through)):
            return [*found]
    # an article inside furniture, if there is less text outside it; where no text varies
    # (one page), all texts count
    found = list(_places(wrapper, "article", either, NAMED))
    for view in (lambda n: n, _slots):
        inside, outside = sum(_weight(view(c)) for _, c in found), _weight(view(wrapper))
        if inside > outside:
            return [*dict(found)]
        if outside:
            break
    path, node = (), wrapper
    slots = wrapper if _weight(wrapper, True) else _slots(wrapper)
    forms = _weight(slots, True) > 2 * _weight(slots)       # most of the text is in forms
    if forms:
        node = slots
    while True:
        inner = [c for c in node[CHILDREN] if c[KIND] != "#" and (
            c[FURNISHED] < NAMED or forms and _page_form(c))]
        heaviest = max(inner, key=lambda n: _weight(n, forms), default=None)
        if heaviest is None or _weight(heaviest, forms) * 2 < _weight(node, forms) or not _weight(heaviest, forms) \
                or not any(c[KIND] != "#" for c in heaviest[CHILDREN]):
            return [path]
        path, node = (*path, heaviest[KIND]), heaviest


def _texts(node: list) -> Iterator[list]:
    if node[KIND] == "#":
        yield node
    for c in node[CHILDREN] if node[KIND] != "#" else ():
        yield from _texts(c)


def _chars(node: list) -> int:
    return sum(t[CHILDREN][0] for t in _texts(node))


def _heads(node: list) -> bool:
    """Whether a page's main heading is in an element."""
    return any(c[KIND].partition(".")[0] == "h1" or _heads(c) for c in node[CHILDREN] if c[KIND] != "#")


def _holders(places: Iterable[tuple]) -> set[tuple]:
    return {p[:i] for p in places for i in range(1, len(p) + 1)}


def dropped(wrapper: list, varied: bool, places: Iterable[tuple]) -> set[tuple]:
    """Paths of the hinted elements that the host's pages show to be furniture; pages of
    one and the same text (not ``varied``) show nothing. An element with a compound name (comment-list,
    ad-slot, sidebar-left) is furniture if it is neither most of the text nor around the heading."""
    holders = _holders(places)
    most = _chars(wrapper) / 2
    named = any(p[-1:] and p[-1].partition(".")[0] == "article" and not p[-1].endswith(f".{HINTED}")
                for p in places)
    verdicts: dict[tuple, bool] = {}

    def judge(node: list, path: tuple, always: bool):
        for c in node[CHILDREN]:
            own, every = (*path, c[KIND]), always and c[TIMES] in "1+"
            if c[KIND] == "#" or c[FURNISHED] >= NAMED and own not in holders:
                continue
            if c[FURNISHED] == HINTED:
                if c[KIND].partition(".")[0] == "article":
                    gone = named
                else:
                    texts = list(_texts(c))
                    words = set(c[KIND].split(".")[1:-1])
                    gone = every and varied and (
                        all(t[TEXT] is not None for t in texts)
                        or sum(t[CHILDREN][1] for t in texts) * 2 > sum(t[CHILDREN][0] for t in texts))
                    gone = gone or own not in holders and _compound(words) and _chars(c) <= most and not _heads(c)
                verdicts[own] = gone and verdicts.get(own, True)
            judge(c, own, every)

    judge(wrapper, (), True)
    return {p for p, gone in verdicts.items() if gone}


def _blocks(node: list, places: set, holders: set, gone: set, path: tuple, inside: bool) -> Iterator[str]:
    inside = inside or path in places
    for c in node[CHILDREN]:
        if c[KIND] == "#":
            if inside:
                yield c[TEXT]
            continue
        own = (*path, c[KIND])
        if own in holders or c[FURNISHED] < NAMED and own not in gone:
            yield from _blocks(c, places, holders, gone, own, inside)


def article(page: str, places: set[tuple], gone: set[tuple] = frozenset()) -> str:
    """The main text of one page, given where its host's wrapper has the article and
    which hinted elements it shows to be furniture."""
    tree = parse(page)
    if not any(_present(tree, p) for p in places):
        own = [tree[KIND], "1", PLAIN, [_slots(c) for c in tree[CHILDREN]], None]
        places = set(main_places(own))
        gone = gone | dropped(own, False, places)
    return "\n\n".join(_blocks(tree, places, _holders(places), gone, (), False))


def _present(node: list, path: tuple) -> bool:
    return not path or any(_present(c, path[1:]) for c in node[CHILDREN] if c[KIND] == path[0])


def _slots(node: list) -> list:
    if node[KIND] == "#":
        return [*node[:TEXT], None]
    return [*node[:CHILDREN], [_slots(c) for c in node[CHILDREN]], None]


def _own(node: list) -> int:
    """A digest of the texts of a page outside furniture and what may be furniture; an
    article or main element in them counts."""
    def texts(n: list, on: bool) -> Iterator[str]:
        for c in n[CHILDREN]:
            if c[KIND] == "#":
                if on:
                    yield c[TEXT]
            elif c[FURNISHED] < ALWAYS:
                yield from texts(c, on and c[FURNISHED] == PLAIN
                                 or c[KIND].partition(".")[0] in ("article", "main"))

    return zlib.crc32("\n".join(texts(node, True)).encode("utf-8", "replace"))


def infer(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, lo, hi)``: the wrapper of every host, as JSON, and the smallest
    and largest digest of its pages' plain texts, from ``(host, html)``."""
    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            hosts, done = b.column(0).to_pylist(), 0
            wrappers: dict[str, list] = {}
            seen: dict[str, tuple[int, int]] = {}
            for texts in texts_of(b.column(1)):
                for text in texts:
                    host, root = hosts[done], parse(text)
                    done += 1
                    own, tree = _own(root), folded(root[CHILDREN])
                    lo, hi = seen.get(host, (own, own))
                    seen[host] = min(lo, own), max(hi, own)
                    wrappers[host] = align(wrappers[host], tree) if host in wrappers else tree
            yield pa.RecordBatch.from_arrays(
                [pa.array([*wrappers], pa.string()),
                 pa.array(map(json.dumps, wrappers.values()), pa.string()),
                 *(pa.array([seen[h][i] for h in wrappers], pa.int64()) for i in (0, 1))], columns)

    def meet(table):
        import pyarrow as pa

        whole = None
        for text in sorted(table.column("wrapper").to_pylist()):
            whole = json.loads(text) if whole is None else align(whole, json.loads(text))
        return pa.table({"host": table.column("host").to_pylist()[:1], "wrapper": [json.dumps(whole)],
                         "lo": [min(table.column("lo").to_pylist())],
                         "hi": [max(table.column("hi").to_pylist())]})

    columns, schema = ["host", "wrapper", "lo", "hi"], "host string, wrapper string, lo long, hi long"
    parts = pages.mapInArrow(partial, schema)
    shared = parts.withColumn("share", F.pmod(F.xxhash64("wrapper"), F.lit(SHARES)))
    return (shared.groupBy("host", "share").applyInArrow(
        lambda t: meet(t.select(columns)), schema)
        .groupBy("host").applyInArrow(meet, schema))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for every page. The wrappers are joined to the pages by
    host and share, so that a hot host is read by as many tasks as there are shares."""
    rows = pages.select(
        F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")),
                                 r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    wrappers = infer(rows.select("host", "html")).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    rows = rows.withColumn("share", F.pmod(F.xxhash64("page_id", "html"), F.lit(SHARES)).cast("int"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known: dict[tuple, tuple] = {}
        for b in batches:
            wrapped, done, out = list(zip(*(b.column(i).to_pylist() for i in (3, 4, 5)))), 0, []
            for texts in texts_of(b.column(2)):
                for page in texts:
                    key = wrapper, lo, hi = wrapped[done]
                    done += 1
                    if key not in known:
                        if len(known) > 4096:
                            known.clear()
                        tree = ["", "1", PLAIN, json.loads(wrapper) if wrapper else [], None]
                        places = set(main_places(tree))
                        known[key] = places, dropped(tree, lo != hi, places)
                    out.append(article(page, *known[key]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    kind = dict(rows.dtypes)["page_id"]
    return (rows.join(wrappers, ["host", "share"], "left").select("page_id", "url", "html", "wrapper", "lo", "hi")
            .mapInArrow(run, f"page_id {kind}, url string, text string"))
