"""Main text of web pages by template deduction over the pages of a host.

Tokens are the structural tags of a page and the runs of text between them, with their path. Tokens
whose numbers of occurrences agree on every page of a host form an equivalence class. Large frequent
classes, each nested in one slot of another, are the host's template; of its slots those are read
whose texts, over the pages of the host, are an article's.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from thermocline.llm.rows import add_columns, col_of, map_arrow, others, own_memory, slices
from thermocline.llm.storage import fresh, stored

#: A token is frequent on a host if this share of its pages has it.
SUPPORT = 0.5
#: Different pages from which on a host's tokens show a template: one page alone has nothing to compare.
MIN_PAGES = 2
#: Tokens from which on a class is large.
LARGE = 3
#: A slot is no article's if this share of its text stands on several pages of the host.
REPEATED = 0.5
#: A slot beside the main one is read if it has at least this share of its text.
BESIDE = 0.25
#: An article or main element is the text's slot if it holds at least this share of the host's text.
SHARE = 0.6
#: Tokens a task sums up before it hands them on.
HELD = 200_000

#: Elements that part blocks of text, and make up paths. Fixed values.
STRUCTURE = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without text of the article. Fixed values.
OTHER = frozenset("aside button dialog fieldset footer form head header iframe menu nav noscript object script select style svg template textarea title".split())
#: Names in class, id or role that mark such elements; a name counts as a whole ("sidebar", "site-footer"), not by its parts ("with-sidebar"). Fixed values.
_MARK = "(?:ad|ads|adv|advert|adverts|advertisement|alert|banner|breadcrumb|breadcrumbs|comment|comments|contentinfo|cookie|cookies|copyright|disqus|footer|header|masthead|menu|nav|navbar|navigation|newsletter|notice|notices|pagination|popup|promo|related|replies|respond|search|share|sharing|sidebar|social|sponsor|sponsored|subscribe|tags|toolbar|widget)"
MARKS = re.compile(
    rf"(?:^|\s)(?:(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global)[_-])*{_MARK}(?:[_-](?:area|bar|box|left|right|links|list|buttons|{_MARK}))*|(?:post|entry|article)[_-](?:comments?|nav|navigation|related|share|sharing|tags))(?:[_-]?#)?(?!\S)",
    re.I,
)
#: If marked elements hold at least this share of the running text, it is the article's.
MARKED_SHARE = 0.9
#: Marks that a paragraph of an article may have.
_OF_TEXT = re.compile(r"(?:^|\s)(?:alert|notices?|related|search|share|tags)(?!\S)", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements of running text, which repeat without being records. Fixed values.
_FLOW = frozenset("blockquote dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|textarea|title|noscript|iframe|svg|template|object|select"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<({_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_DIGITS = re.compile(r"\d+")
_ARTICLE_TAG = re.compile(r"<(?:article|main)[\s/>]", re.I)
#: A start tag that ends these open ones: what HTML leaves out.
_ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}


class Node:
    """An element: id stands for its path, other says that it, or what it stands in, is one of OTHER; marked is the innermost marked element up to it."""

    __slots__ = ("name", "label", "id", "depth", "other", "marked", "parent", "number", "article", "slot")

    def __init__(self, name: str, label: str, other: bool, parent: Node | None, number: int):
        self.name, self.label, self.parent, self.number = name, label, parent, number
        self.id = path_id(label, parent.id) if parent else 0
        self.depth = parent.depth + 1 if parent else 0
        self.other = other or (parent is not None and parent.other)
        self.marked: Node | None = parent.marked if parent else None
        self.article = name in ("article", "main") or (parent is not None and parent.article)
        self.slot: Node | None = parent.slot if parent else None

    @property
    def hides(self) -> bool:
        return self.other or self.marked is not None


def path_id(path: str, above: int = 0) -> int:
    """The number of a path of labels, parted by "/", below the path of number above: paths of deep pages are never spelt out."""
    for label in path.strip("/").split("/"):
        above = xxhash.xxh3_64_intdigest(f"{above}/{label}".encode("utf-8", "surrogatepass")) >> 1
    return above


def walk(page: str) -> Iterator[tuple[str, Node, str, bool]]:
    """A page as ("open", node, "", False) and ("close", ...) for structural tags and ("text", node, text, in a link) for texts with node around them.

    node.hides says that it, or what it stands in, isn't part of an article. A mark doesn't hide
    an element with an article or main element inside, if marks would hide all those of the page.
    """
    spared: set[int] = set()
    if _ARTICLE_TAG.search(page):
        for kind, node, _, _ in _walk(page, spared):
            if kind == "open" and node.name in ("article", "main") and not node.other:
                if node.marked is None:
                    spared = set()
                    break
                up = node.marked
                while up is not None and up.number not in spared:
                    spared.add(up.number)
                    up = up.parent.marked
    return _walk(page, spared)


def _walk(page: str, spared: set[int]) -> Iterator[tuple[str, Node, str, bool]]:
    root = Node("", "", False, None, 0)
    number = 0
    stack = [root]
    links = 0
    at = 0

    def pop_to(names: set[str], border: frozenset[str]) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                del stack[k:]
                return
            if stack[k].name in border:
                return

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", stack[-1], page[at : m.start()], links > 0
        at = m.end()
        name = m[3] or m[6]
        if not name:
            continue
        name, closing = name.lower(), (m[2] or m[5]) == "/"
        if name == "a":
            links = 0 if closing else 1
            continue
        if name not in STRUCTURE:
            if name == "br":
                yield "text", stack[-1], " ", links > 0
            continue
        links = 0
        if closing:
            pop_to({name}, frozenset() if name != "p" else frozenset({"article", "div", "section", "body", "td", "li"}))
            yield "close", stack[-1], "", False
            continue
        if name == "p" or name in ("ul", "ol", "div", "section", "article", "nav", "footer", "header", "aside", "form", "table", "blockquote", "pre", "main", "h1", "h2", "h3", "h4", "h5", "h6"):
            if stack[-1].name == "p":
                stack.pop()
        elif name in _ENDS:
            pop_to(_ENDS[name], frozenset({"ul", "ol", "dl", "table", "tbody", "thead", "div"} | ({"tr"} if name in ("td", "th") else set())))
        if name == "body":
            pop_to({"head"}, frozenset())
        marks = {k.lower(): _DIGITS.sub("#", " ".join((a or b or c).split())).replace("/", "|") for k, a, b, c in _ATTRIBUTE.findall(m[4] or m[7] or "")}
        label = name + "".join(f"[{k}={v}]" for k, v in sorted(marks.items()) if v)
        parent = stack[-1]
        number += 1
        node = Node(name, label, name in OTHER, parent, number)
        if name not in ("body", "html", "main", "article") and number not in spared and any(MARKS.search(_OF_TEXT.sub(" ", v) if name == "p" else v) for v in marks.values()):
            node.marked = node
        yield "open", node, "", False
        if name not in _VOID:
            stack.append(node)
    if at < len(page):
        yield "text", stack[-1], page[at:], links > 0


def host_of(url: Column) -> Column:
    """The host of a URL in small letters; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


_TALLY = "host string, id long, run long, parent long, label string, hides boolean, n_pages long, n_total long, print_a long, print_b long, chars long, place long, marked long, marks long"
_KEYS = ("host", "id", "run", "parent", "label", "hides")
_SUMS = ("n_pages", "n_total", "print_a", "print_b", "chars", "place", "marked", "marks")


def occurrences(pages: DataFrame) -> DataFrame:
    """For every host and token: pages that have it, its occurrences, the fingerprint of its occurrence vector, characters of running text.

    Tokens are structural tags (run 0) and runs of text between tags (run: a hash of the text), both
    with the path they stand at. The fingerprint sums a hash of (page, occurrences) over pages, so
    vectors are compared without being gathered; tasks sum before the shuffle. chars of a tag is the
    text inside it, place the sum of its first places on pages, marked the characters that only
    marks hide, marks the pages where it has a mark of its own. Runs on one page alone, which are
    in no template, are left out: their characters are in the tags'. pages: host, key (of a page), html.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_memory(__name__)
        held: dict[tuple, list[int]] = {}

        def out() -> pa.RecordBatch:
            columns = [list(x) for x in zip(*((*k, *v) for k, v in held.items()))] or [[] for _ in range(14)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), *[pa.int64()] * 8]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _TALLY.split(", ")])

        for batch in batches:
            for part in slices(batch, "html"):
                for host, key, page in zip(*(part.column(k).to_pylist() for k in range(3))):
                    for token, values in _page_tokens(page or "", key).items():
                        row = held.setdefault((host, *token), [0] * 8)
                        for k, x in enumerate(values):
                            row[k] += x
                if len(held) > HELD:
                    yield out()
                    held = {}
        yield out()

    tallied = map_arrow(pages.select("host", "key", "html"), run, _TALLY).groupBy(*_KEYS).agg(*(F.sum(c).alias(c) for c in _SUMS))
    return tallied.where("run = 0 OR n_pages > 1")


def _page_tokens(page: str, key: str) -> dict[tuple, tuple]:
    """Tokens of a page as (id, run, parent, label, hides) with what each adds to the sums."""
    count: dict[tuple[int, bool], int] = {}
    first: dict[int, Node] = {}
    marks: set[int] = set()
    chars: dict[int, list[int]] = {}
    runs: dict[tuple[int, int], list[int]] = {}
    for kind, node, text, linked in walk(page):
        if kind == "open":
            if node.marked is node:
                marks.add(node.id)
            first.setdefault(node.id, node)
            if node.id:
                count[node.id, node.hides] = count.get((node.id, node.hides), 0) + 1
        elif kind == "text" and (not linked or node.name == "h1") and not node.other:
            text = text.strip()
            if text:
                of = chars.setdefault(node.id, [0, 0])
                of[node.marked is not None] += len(text)
                if node.marked is None:
                    of = runs.setdefault((node.id, xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 or 1), [0, 0])
                    of[0] += 1
                    of[1] += len(text)
    # an element is opened after the one around it, so sums go upwards in one pass
    for path, node in reversed(first.items()):
        if path in chars and node.parent is not None:
            of = chars.setdefault(node.parent.id, [0, 0])
            of[0] += chars[path][0]
            of[1] += chars[path][1]

    def prints(n: int) -> tuple[int, int]:
        a = xxhash.xxh3_64_intdigest(f"{key}:{n}".encode())
        return a & 0x7FFFFFFF, a >> 33

    found = {}
    for (path, hides), n in count.items():
        own, marked = chars.get(path, (0, 0))
        node = first[path]
        found[path, 0, node.parent.id, node.label, hides] = (1, n, *prints(n), own, node.number, marked, path in marks)
    for (path, text), (n, size) in runs.items():
        found[path, text, path, "", False] = (1, n, *prints(n), size, 0, 0, 0)
    return found


def template(tokens: list[dict]) -> list[tuple[int, list[int]]]:
    """The template of a host: its large equivalence classes, outermost first, as (tag whose slot they stand in, their tags).

    tokens are frequent ones, as rows of occurrences(). A class is valid if its tokens nest in one
    slot: above each of them, the nearest tag of another class is the same. Of an invalid class
    the most tokens that do so are kept (the outermost of equally many), the others go. A class is
    large from LARGE tokens on: a tag counts as two, its start and its end, a run of text as one.
    """
    tags = {t["id"]: t for t in tokens if not t["run"]}
    classes: dict[tuple, list[dict]] = {}
    for t in tokens:
        classes.setdefault((t["n_pages"], t["n_total"], t["print_a"], t["print_b"]), []).append(t)
    of = {t["id"]: k for k, members in classes.items() for t in members if not t["run"]}
    # the nearest tag of another class, and the depth, of every tag: outermost first, as parents are looked up
    slot: dict[int, int] = {}
    depth: dict[int, int] = {0: 0}

    def settle(path: int) -> None:
        chain = []
        while path in tags and path not in depth:
            chain.append(path)
            path = tags[path]["parent"]
        for p in reversed(chain):
            up = tags[p]["parent"]
            depth[p] = depth.get(up, 0) + 1
            slot[p] = 0 if up not in of else up if of[up] != of[p] else slot[up]

    for path in tags:
        settle(path)

    def slot_of(t: dict, key: tuple) -> int:
        if not t["run"]:
            return slot[t["id"]]
        return t["id"] if of.get(t["id"]) != key else slot[t["id"]]

    found = []
    for key, members in classes.items():
        parts: dict[int, list[dict]] = {}
        for t in members:
            parts.setdefault(slot_of(t, key), []).append(t)
        size = {p: sum(1 if t["run"] else 2 for t in ts) for p, ts in parts.items()}
        where = min(parts, key=lambda p: (-size[p], depth.get(p, 0), p))
        if size[where] >= LARGE:
            found.append((where, sorted({t["id"] for t in parts[where] if not t["run"]}, key=lambda p: (depth[p], p))))
    return sorted(found, key=lambda x: (depth.get(x[0], 0), x[0], x[1]))


def text_slots(tokens: list[dict]) -> list[int]:
    """Numbers of the slots that hold the text, the main one first; what isn't read inside of them follows as negative numbers. Empty if the template has none.

    Slots are the insides of the template's tags that occur once a page. Text of a slot is its own
    (outside the slots within it) without runs that are template. The main slot has the most text
    of its own. Of the others with text that isn't mostly repeated on several pages (rotating offers,
    notices), these are read beside it: before it, headings and what follows a heading; anywhere,
    those with BESIDE of the main slot's text that don't consist of records (comments: repeated
    elements with elements in them). A slot around the main one is read instead if it has BESIDE
    of its text, and so is an article or main element around it with SHARE of the host's text: here names
    break ties. Slots inside with nothing but repeated text aren't read. Where marks hide MARKED_SHARE
    of the text, the innermost marked tag around so much of it is the slot; none, if there is no such tag.
    tokens: rows of occurrences() with repeated, the characters in runs on several pages, and fixed, those in frequent runs, directly in a tag.
    """
    tokens = sorted(tokens, key=lambda t: (t["id"], t["run"], not t["hides"]))
    tags = [t for t in tokens if not t["run"]]
    everything = max([t["chars"] + t["marked"] for t in tags], default=0)
    parent = {t["id"]: t["parent"] for t in tags}

    def above(p: int) -> Iterator[int]:
        while p := parent.get(p, 0):
            yield p

    if any(t["marked"] >= MARKED_SHARE * everything > 0 for t in tags):
        inner = [t for t in tags if t["marked"] >= MARKED_SHARE * everything and t["marks"] and t["n_total"] == t["n_pages"]]
        return [min(inner, key=lambda t: (-sum(1 for _ in above(t["id"])), t["id"]))["id"]] if inner else []
    by_id = {t["id"]: t for t in tags if not t["hides"]}
    single = {p for _, paths in template(tokens) for p in paths if p in by_id and by_id[p]["n_total"] == by_id[p]["n_pages"] and by_id[p]["chars"] > 0}
    holder: dict[int, int] = {}

    def holder_of(p: int) -> int:
        """The slot that p is, or stands in."""
        chain = []
        while p and p not in single and p not in holder:
            chain.append(p)
            p = parent.get(p, 0)
        found = holder.get(p, p)
        holder.update(dict.fromkeys(chain, found))
        return found

    up = {p: holder_of(parent.get(p, 0)) for p in single}
    inwards = sorted(single, key=lambda p: (by_id[p]["place"] / by_id[p]["n_pages"], p))
    placed: dict[int, None] = {}
    for p in inwards:
        chain = []
        while p and p not in placed:
            chain.append(p)
            p = up[p]
        placed.update(dict.fromkeys(reversed(chain)))
    inwards = list(placed)

    def under(some: set[int]) -> set[int]:
        """Slots that stand in one of some."""
        found: set[int] = set()
        for p in inwards:
            if up[p] in some or up[p] in found:
                found.add(p)
        return found

    def number_in(some: set[int]) -> dict[int, int]:
        """How many of some each slot holds, itself included."""
        n = {p: int(p in some) for p in single}
        for p in reversed(inwards):
            if up[p]:
                n[up[p]] += n[p]
        return n

    chars = {p: by_id[p]["chars"] for p in single}
    repeated, fixed = dict.fromkeys(single, 0), dict.fromkeys(single, 0)
    for p, outer in up.items():
        if outer:
            chars[outer] -= by_id[p]["chars"]
    for p, t in by_id.items():
        if here := holder_of(p):
            repeated[here] += t["repeated"]
            fixed[here] += t["fixed"]
    own = {p: chars[p] - fixed[p] for p in single}
    place = {p: by_id[p]["place"] / by_id[p]["n_pages"] for p in single}
    main = min(single, key=lambda p: (-own[p], place[p], p), default=0)
    if not main or own[main] <= 0:
        return []

    def name(p: int) -> str:
        return by_id[p]["label"].split("[")[0]

    def share(p: int) -> float:
        return repeated[p] / chars[p] if chars[p] > 0 else 1.0

    content = {p for p in single if own[p] > 0 and share(p) < max(REPEATED, share(main))} | {main}
    held = number_in(content)
    least = BESIDE * own[main]
    outer = [p for p in above(main) if p in content and own[p] >= least]
    main = outer[-1] if outer else main
    total = max(t["chars"] for t in by_id.values())
    around = [p for p in (main, *above(main)) if p in single and name(p) in ("article", "main") and by_id[p]["chars"] >= SHARE * total]
    for k, p in enumerate(around):
        # the innermost, but for those that hold other text beside it
        if not k or held[p] > held[main]:
            main = p
    parents = {parent[p] for p in by_id}
    records = {holder_of(p) for p, t in by_id.items() if t["n_total"] > t["n_pages"] and p in parents and name(p) not in _FLOW}
    title = min((place[p] for p in content if name(p) in _HEADINGS and place[p] < place[main]), default=place[main])
    wide = set(above(main))
    beside = {p for p in content - wide if title <= place[p] < place[main] or (own[p] >= least and p not in records)}
    chosen = beside | {main}
    chosen -= under(chosen)
    # loose text around the main slot is read where nothing would come along that isn't
    left = number_in({p for p in single - chosen - under(chosen) - wide if chars[p] > 0})
    for p in [q for q in above(main) if q in content]:
        if left[p]:
            break
        chosen.add(p)
        main = p
    chosen -= under(chosen)
    hidden: set[int] = set()
    if share(main) < REPEATED:
        alike = {p for p in under(chosen) if name(p) not in _HEADINGS and chars[p] > 0 and share(p) >= MARKED_SHARE}
        hidden = {p for p in alike if not held[p]}
    return [main, *sorted(chosen - {main}, key=lambda p: (place[p], p)), *(-p for p in sorted(hidden))]


def article(page: str | None, slot: str) -> str:
    """Text of a page's slots (numbers as of text_slots(), parted by blanks) in page order, blocks parted by an empty line. Without the first slot, or where an article or main element stands outside of it, the text of that element; else of the page.

    Marks up to a slot don't hide it. Without a slot, marks that hide MARKED_SHARE of the text are not heeded.
    """
    if not page:
        return ""
    numbers = [int(x) for x in slot.split()]
    slots, hidden = {x for x in numbers if x > 0}, {-x for x in numbers if x < 0}
    first = numbers[0] if numbers else 0
    blocks: dict[str, list[str]] = {"slot": [], "element": [], "page": [], "element, marked": [], "page, marked": []}
    held: dict[str, list[str]] = {k: [] for k in blocks}
    chars = dict.fromkeys(blocks, 0)
    last: Node | None = None

    def close() -> None:
        for k, parts in held.items():
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                blocks[k].append(text)
            parts.clear()

    seen = {"slot": False, "in element": False, "element": False}
    for kind, node, text, linked in walk(page):
        if kind == "close":
            close()
            continue
        if kind == "open":
            close()
            if node.id in slots:
                node.slot = node
            elif node.id in hidden:
                node.slot = None
            if node.id == first:
                seen["slot"] = True
                seen["in element"] |= node.article
            seen["element"] |= node.name in ("article", "main")
            continue
        if node is not last and last is not None:
            close()
        last = node
        if node.other:
            continue
        n = 0 if linked else len(text.strip())
        if node.slot is not None and (node.marked is None or node.marked.depth <= node.slot.depth):
            held["slot"].append(text)
        for k in ("page", "element") if node.article else ("page",):
            for name in (k + ", marked",) if node.marked is not None else (k, k + ", marked"):
                held[name].append(text)
                chars[name] += n
    close()
    best = "slot" if seen["slot"] and (seen["in element"] or not seen["element"]) else "element" if seen["element"] else "page"
    if best != "slot":
        every = best + ", marked"
        if chars[every] and chars[best] <= (1 - MARKED_SHARE) * chars[every]:
            best = every
    return "\n\n".join(blocks[best])


def once_each(pages: DataFrame) -> DataFrame:
    """pages (host, html) with copies of a page on its host once, and key, a hash of the page. Only texts that have copies are shuffled."""
    hashed = pages.where("html IS NOT NULL AND html <> ''").select("host", "html", F.xxhash64("html").alias("hash"), F.octet_length("html").alias("size"))
    copied = stored(hashed.groupBy("host", "hash", "size").count().where("count > 1").drop("count"), "copied-pages")
    keys = ["host", "hash", "size"]
    alone = hashed.join(copied, keys, "left_anti").select(*keys, "html")
    first = hashed.join(copied, keys, "left_semi").groupBy(*keys).agg(F.first("html").alias("html"))
    return alone.unionByName(first).select("host", F.concat_ws(":", "hash", "size").alias("key"), "html")


def host_slots(pages: DataFrame) -> DataFrame:
    """Columns host, slot: the numbers of text_slots(), parted by blanks. A host's frequent tokens are at most (mean tokens a page) / SUPPORT, however many pages it has. pages: host, html."""
    once = once_each(pages)
    counted = stored(occurrences(once), "occurrences")
    totals = stored(once.groupBy("host").agg(F.count("*").alias("n_host")), "host-pages")
    frequent = (F.col("n_pages") >= SUPPORT * F.col("n_host")) & (F.col("n_host") >= MIN_PAGES)
    known = counted.join(totals, "host")
    runs = known.where("run <> 0").groupBy("host", "id").agg(F.sum("chars").alias("repeated"), F.sum(F.when(frequent, F.col("chars")).otherwise(0)).alias("fixed"))
    tokens = known.where(frequent).join(runs, ["host", "id"], "left")
    token = F.struct(*_KEYS[1:], *_SUMS, F.coalesce("repeated", F.lit(0)).alias("repeated"), F.coalesce("fixed", F.lit(0)).alias("fixed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([" ".join(map(str, text_slots(t))) for t in batch.column(1).to_pylist()], pa.string())], names=["host", "slot"])

    return map_arrow(tokens.groupBy("host").agg(F.collect_list(token).alias("tokens")), run, "host string, slot string")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """pages with the main text added, or replaced if it is there; never null.

    Null and empty pages, and those without running text, have the empty text. A page without its
    host's slot (cut off, or of another make) is read by its article or main element, else whole,
    always without what isn't article. Repeated pages are each returned, and counted once. All other columns pass through.
    """
    host, slot, of = fresh(pages, "page_host", "host_slot", "slot_of")
    kept = others(pages, text)
    rows = pages.select(*map(col_of, kept), host_of(col_of(url)).alias(host))
    slots = stored(host_slots(rows.select(col_of(host).alias("host"), col_of(html).alias("html"))), "host-slots")
    joined = rows.join(slots.select(F.col("host").alias(of), F.col("slot").alias(slot)), col_of(host) == col_of(of), "left").select(*map(col_of, kept), F.coalesce(slot, F.lit("")).alias(slot))

    def make():
        return lambda raw, where: [pa.array([article(p, s) for p, s in zip(raw.to_pylist(), where.to_pylist())], pa.string())]

    return add_columns(joined, [html, slot], {text: T.StringType()}, make).drop(slot)
