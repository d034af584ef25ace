"""Main text of web pages by consensus host paths.

1. Each page's containers are scored by the share of its text that they hold,
   links, menus, adverts and the like aside; a wrapper of a container with nearly
   all its text doesn't count, unless it is an article or main element. Votes go to generalised paths (tags with classes,
   digits folded) of the page's host and are summed in Spark, where a host with a
   third of all pages is pre-aggregated before the shuffle.
2. Paths are ranked per host by their votes for each page that has them, and those
   that are the best of some page are joined back, but none that holds little on
   most pages that have it (such as a body around everything). Each page is extracted again
   from the elements on the best-ranked path that it has: pages of another template
   have another best path. Where those elements hold no fair share of the page's
   unlinked text and an article or main element does, or where none of the paths is
   there, the page uses its own best container; one without any container is a
   single block list.

Outside article and main elements, the headings and unlinked paragraphs that stand
directly in a container around the chosen one, and boxes of headings only, are kept too.
Blocks are cut at block-level tags. A null or empty page gives an empty text.
The table of hosts is broadcast up to ``BROADCAST_HOSTS`` rows and shuffled beyond.

A form goes unless it wraps the page: with ``FORM_PROSE`` unlinked characters or more for each of its
controls it counts as a plain container. Classes of html and body are not looked at, nor are those of main but for comments.
Class and id words of menus, adverts and the like take a container out by themselves only
where they are a whole class or stand beside filler words; in a longer name, or as an id in
an article, only together with a text that consists of links. Within an article, words that it may have on boxes of its own (such as
share, search or notice) take out only boxes of links and boxes without an unlinked paragraph. Paragraphs, headings and
inline elements go by a few unmistakable whole classes alone.

A page is parsed in time linear in its length, however broken: once a tag does not end, tags
end at the next angle bracket. Repeated rows each get their text, rows with a null url share
the host "". Equal scores go to the larger path. An empty table gives an empty result, and
columns beside page_id, url and html are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm.common import cut, table

BROADCAST_HOSTS = 500_000
WRAPPED = 0.9
#: Hosts of more paths than this have them joined one by one instead of as a list; the result is the same.
LISTED = 256
#: A path's votes count as if so many more pages had it without a vote, so that no rare path leads by chance.
PRIOR = 2
#: One over the share of a page's unlinked text that a container needs for a vote.
FAIR = 5
#: Markup that starts at a "<"; every part but a tag's quoted values stops at the next "<", so nothing is scanned twice.
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[|<[!?][^<>]*>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=|[\"'])*+)(>?)",
    re.S,
)
#: The same without quoted values, for the rest of a page in which a quotation mark does not close.
PLAIN = re.compile(r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[|<[!?][^<>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)(>?)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:@-][\w:.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f\v  -     　 \u0085]+")
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
BOXES = set("article main section div td body html center".split())
DROP = set(
    "nav footer aside script style head title noscript template iframe object svg canvas select button textarea "
    "input option dialog menu audio video math".split()
)
#: Class and id words of what isn't the article.
ODD = set(
    "ad ads adv advert adverts advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr "
    "notice notices alert newsletter subscribe subscription popup modal overlay sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs pagination pager share sharing social related recommended comment comments disqus respond "
    "replies footer masthead toolbar widget login signup search skip hidden copyright legal topbar".split()
)
#: Words beside them that say nothing of the content.
FILLER = set(
    "a an the area bar block bottom box btn button buttons center cnt col column container content foot form group header holder icons "
    "inner item items l left line links list main module outer page panel post primary r right row secondary section side site slot small "
    "text top unit wrap wrapper x".split()
)
#: Whole classes that take out paragraphs and inline elements too.
CLEAR = set("ad ads adv advert adverts advertisement advertising adsense sponsored cookie cookies newsletter breadcrumb breadcrumbs pagination".split())
#: Words that an article may have on boxes of its own, such as a section on market share.
DOUBTFUL = set("notice notices alert share sharing social search related recommended widget legal copyright toolbar skip pager topbar masthead overlay".split())
CONTROLS = set("input select textarea button".split())
#: Unlinked characters for each control from which a form is a wrapper of the page rather than a form of it.
FORM_PROSE = 300
CONTAINERS = set("div section ul ol dl table figure details td center".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
HEADS = set("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_BLOCK = HEADS | {"p"}
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}


class Node:
    """A container: its path, and the blocks that its subtree holds as a range of the page's blocks."""

    __slots__ = ("path", "first", "last", "depth", "parent", "own", "plain")

    def __init__(self, path: str, first: int, depth: int, parent: int):
        self.path, self.first, self.last, self.depth, self.parent = path, first, -1, depth, parent
        self.own: list[int] = []  # blocks in no container inside
        self.plain = False  # holds more than headings

    @property
    def semantic(self) -> bool:
        return self.path.rsplit(">", 1)[-1].split(".")[0] in ("article", "main")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _name(tag: str, attrs: dict[str, str]) -> str:
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", w) for w in attrs.get("class", "").lower().split()})])


def _odd(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    """0: part of the content by its name, 1: not, 2: not if its text consists of links, 3: not without an unlinked paragraph, 4: a form."""
    if tag in DROP or tag == "header" and not in_article:
        return 1
    if not attrs:
        return 4 if tag == "form" else 0
    classes = attrs.get("class", "").lower().split()
    style = attrs.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    if tag in ("html", "body"):
        return 0
    if tag in ("article", "main"):
        return int({"comment", "comments"} & set(classes) != set())
    if hidden or attrs.get("role", "").lower() in ROLES:
        return 1
    if tag not in CONTAINERS:
        return 1 if not CLEAR.isdisjoint(classes) else 4 if tag == "form" else 0
    odd = 0
    for name, is_id in [*((c, False) for c in classes), (attrs.get("id", "").lower(), True)]:
        words = set(re.findall(r"[a-z]+", name))
        if not words.isdisjoint(ODD) or not in_article and words == {"header"}:
            sure = all(w in ODD or w in FILLER for w in words) and not (is_id and in_article)
            doubtful = in_article and not is_id and words & ODD <= DOUBTFUL
            odd = 1 if sure and not doubtful or odd == 1 else max(odd, 3 if sure else 2)
    return odd


class _Stack:
    """Open elements, with the places of each tag, so that the nearest one is found at once."""

    def __init__(self) -> None:
        # tag, node or -1, odd, article, first block if suspect else -1, kind by its name, controls before it
        self.rows: list[tuple[str, int, bool, bool, int, int, int]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, row: tuple[str, int, bool, bool, int, int, int]) -> None:
        self.places.setdefault(row[0], []).append(len(self.rows))
        self.rows.append(row)

    def pop(self) -> tuple[str, int, bool, bool, int, int, int]:
        row = self.rows.pop()
        self.places[row[0]].pop()
        return row

    def nearest(self, tags: set[str]) -> int:
        """Place of the nearest open element of tags, or -1."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)


def parse(page: str) -> tuple[list[str], list[int], list[Node]]:
    """Blocks of text outside odd parts, the characters of each that are links, and the containers."""
    blocks: list[str] = []
    links: list[int] = []
    nodes = [Node("", 0, 0, -1)]
    stack = _Stack()
    sums: list[tuple[int, int]] = [(0, 0)]  # characters and linked ones before each block
    own: list[str] = []
    paragraph: list[bool] = []  # whether each block is one
    linked, anchors, odd, articles, box, heads, texts, controls = 0, 0, 0, 0, 0, 0, 0, 0
    path: list[str] = [""]  # hashes of the chains of names down to each open container

    def flush() -> None:
        nonlocal linked
        if own:
            text = SPACE.sub(" ", html.unescape("".join(own))).strip(" ")
            if text:
                blocks.append(text)
                links.append(linked)
                paragraph.append(texts > 0)
                sums.append((sums[-1][0] + len(text), sums[-1][1] + linked))
                nodes[box].own.append(len(blocks) - 1)
                nodes[box].plain |= not heads
            own.clear()
        linked = 0

    def forget(first: int, kind: int, before: int) -> None:
        """Take back the blocks from first on, if they aren't content: see _odd."""
        size, within = sums[-1][0] - sums[first][0], sums[-1][1] - sums[first][1]
        if kind == 4:
            gone = size - within < FORM_PROSE * max(1, controls - before)
        else:
            gone = 2 * within >= size or kind == 3 and not any(paragraph[b] and 2 * links[b] < len(blocks[b]) for b in range(first, len(blocks)))
        if first < len(blocks) and gone:
            del blocks[first:], links[first:], paragraph[first:], sums[first + 1 :]
            last = len(nodes) - 1
            while last and nodes[last].first >= first and nodes[last].last >= 0:
                nodes.pop()
                last -= 1
            while nodes[box].own and nodes[box].own[-1] >= first:
                nodes[box].own.pop()

    def pop() -> None:
        nonlocal odd, anchors, articles, box, heads, texts
        tag, node, was_odd, was_article, suspect, kind, before = stack.pop()
        if tag in BLOCK or suspect >= 0:
            flush()
        if node >= 0:
            nodes[node].last = len(blocks)
            box = nodes[node].parent
            path.pop()
        if suspect >= 0:
            forget(suspect, kind, before)
        odd -= was_odd
        articles -= was_article
        anchors -= tag == "a"
        heads -= tag in HEADS
        texts -= tag == "p"

    def close(tags: set[str], stop: set[str]) -> None:
        """Close the nearest open element of tags, unless one of stop is nearer."""
        at = stack.nearest(tags)
        if at > stack.nearest(stop):
            while len(stack.rows) > at:
                pop()

    at, end, token = 0, len(page), TOKEN
    sections = True  # a CDATA section may still end
    while at < end:
        m = token.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not odd:
            own.append(text)
            linked += len(text) if anchors else 0
        if not m:
            break
        if m[2] and not m[4] and token is TOKEN:
            token = PLAIN
            m = token.search(page, m.start())
        at = m.end()
        if m[0] == "<![CDATA[":
            stop = page.find("]]>", at) if sections else -1
            sections = stop >= 0
            at = stop + 3 if sections else (page.find(">", at) + 1 or end)
            continue
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br":
                own.append(" ")
            elif stack.places.get(tag):
                close({tag}, set())
            elif tag in BLOCK:
                flush()
            continue
        if tag == "body":
            close({"head"}, set())
        if tag in BLOCK:
            close(CLOSED_BY_BLOCK, BOXES | {"li", "td", "th", "blockquote", "button"})
            if not odd:
                flush()
        if tag in SIBLINGS:
            close(set(SIBLINGS[tag].split()), {"ul", "ol", "dl", "table", "select"})
        controls += tag in CONTROLS
        if tag in VOID:
            if tag == "br" and not odd:
                own.append(" ")
            continue
        attrs = _attributes(m[3])
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        name = _odd(tag, attrs, articles > 0)
        is_odd = name == 1
        if tag in RAW:
            rest = re.compile(f"</{tag}(?=[\\s/>])[^<>]*>?", re.I).search(page, at)
            if not is_odd and not odd:
                own.append(html.escape(page[at : rest.start()] if rest else page[at:], quote=False))
            at = rest.end() if rest else end
            continue
        if name > 1 and not odd:
            flush()
        suspect = len(blocks) if name > 1 and not odd else -1
        node = -1
        if tag in BOXES and not odd and not is_odd:
            named = _name(tag, attrs)
            path.append(hashlib.blake2b(f"{path[-1]}>{named}".encode("utf-8", "replace"), digest_size=8).hexdigest())
            nodes.append(Node(f"{path[-1]}>{named}", len(blocks), len(path), box))
            box = node = len(nodes) - 1
        stack.push((tag, node, is_odd, tag in ("article", "main"), suspect, name, controls))
        odd += is_odd
        articles += tag in ("article", "main")
        anchors += tag == "a"
        heads += tag in HEADS
        texts += tag == "p"
    while stack.rows:
        pop()
    flush()
    nodes[0].last = len(blocks)
    for n in nodes:
        n.last = len(blocks) if n.last < 0 else n.last
    for n in reversed(nodes[1:]):
        nodes[n.parent].plain |= n.plain
    return blocks, links, nodes


def shares(blocks: list[str], links: list[int], nodes: list[Node]) -> tuple[dict[str, float], dict[str, float]]:
    """By container path: its share of the page's unlinked text, and its score, the share where it has a vote."""
    weight = [0]
    for b, n in zip(blocks, links, strict=True):
        weight.append(weight[-1] + max(0, len(b) - 2 * n))
    total = weight[-1]
    if not total:
        return {}, {}
    held = [weight[n.last] - weight[n.first] for n in nodes]
    covered = [0] * len(nodes)  # the most that a single container inside holds
    for i in range(len(nodes) - 1, 0, -1):
        covered[nodes[i].parent] = max(covered[nodes[i].parent], held[i])
    share: dict[str, float] = {}
    out: dict[str, float] = {}
    for i, n in enumerate(nodes[1:], 1):
        if n.last > n.first:
            share[n.path] = share.get(n.path, 0.0) + held[i] / total
        # a wrapper of one container with nearly all its text leaves the vote to that
        wrapper = covered[i] >= (held[i] if n.semantic else WRAPPED * held[i])
        if held[i] * FAIR >= total and not wrapper:
            out[n.path] = out.get(n.path, 0.0) + held[i] / total
    return share, out


def votes(blocks: list[str], links: list[int], nodes: list[Node]) -> dict[str, float]:
    """Score of each container path: its share of the page's unlinked text."""
    return shares(blocks, links, nodes)[1]


def around(parsed: tuple[list[str], list[int], list[Node]], chosen: list[Node]) -> set[int]:
    """Unlinked blocks directly in the containers around the chosen ones, and those of boxes with only headings there."""
    blocks, links, nodes = parsed
    above: set[int] = set()
    for n in chosen:
        while not n.semantic and n.parent >= 0 and n.parent not in above:
            above.add(n.parent)
            n = nodes[n.parent]
    out: set[int] = set()
    open_ = [False] * len(nodes)
    for i, n in enumerate(nodes):
        open_[i] = i in above or not n.plain and n.parent >= 0 and open_[n.parent]
        if open_[i]:
            out.update(b for b in n.own if 2 * links[b] < len(blocks[b]))
    return out


def choose(parsed: tuple[list[str], list[int], list[Node]], ranked: list[str]) -> str | None:
    """The best-ranked path that the page has, or that of its own best container."""
    share, own = shares(*parsed)
    best = max(own, key=lambda p: (own[p], p)) if own else None
    there = {n.path for n in parsed[2][1:] if n.last > n.first}
    path = next((p for p in ranked if p in there), None)
    if path is None:
        return best
    if share.get(path, 0.0) * FAIR < 1 and any(n.semantic and n.path in own for n in parsed[2][1:]):
        return best
    return path


def extract(parsed: tuple[list[str], list[int], list[Node]], path: str | None) -> str:
    """Blocks of the elements on the path, or of the page's own best container."""
    return extract_ranked(parsed, [path] if path else [])[0]


def extract_ranked(parsed: tuple[list[str], list[int], list[Node]], ranked: list[str]) -> tuple[str, str | None]:
    """Text of the page by its host's ranked paths, and the path used."""
    blocks, _, nodes = parsed
    path = choose(parsed, ranked)
    chosen = [n for n in nodes[1:] if n.path == path] or nodes[:1]
    kept = around(parsed, chosen).union(*[range(n.first, n.last) for n in chosen])
    return "\n\n".join(blocks[b] for b in sorted(kept)), path


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path, rank: the container paths that are the best of some page, ranked by their votes a page that has them."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast: dict[tuple[str, str], list[float]] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                share, own = shares(*parse(page)) if page else ({}, {})
                first = max(own, key=lambda p: (own[p], p)) if own else None
                for path in share:
                    cell = cast.setdefault((host, path), [0.0, 0, 0])
                    cell[0] += own.get(path, 0.0)
                    cell[1] += 1
                    cell[2] += path == first
            rows = [(h, p, *cell) for (h, p), cell in cast.items()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["host", "path", "score", "n", "first"]
            )

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        vote, "host string, path string, score double, n long, first long"
    )
    summed = cast.groupBy("host", "path").agg(F.round(F.sum("score"), 6).alias("score"), F.sum("n").alias("n"), F.sum("first").alias("first"))
    rate = F.col("score") / (F.col("n") + PRIOR)
    kept = summed.filter("first > 0").filter(rate * FAIR >= 1)
    return kept.select("host", "path", F.struct(rate.alias("rate"), "score", "n", "path").alias("rank"))


def best_paths(pages: DataFrame, ranks: DataFrame) -> DataFrame:
    """key, paths: the best-ranked path of each page (key, host, html) among its host's, for hosts of many paths."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hosts, paths = [], [], []
            for key, host, page in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                there = {n.path for n in parse(page)[2][1:] if n.last > n.first} if page else set()
                keys += [key] * len(there)
                hosts += [host] * len(there)
                paths += there
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(hosts, pa.string()), pa.array(paths, pa.string())], names=["key", "host", "path"])

    has = pages.select("key", "host", "html").mapInArrow(own, "key string, host string, path string")
    best = has.join(ranks, ["host", "path"]).groupBy("key").agg(F.max("rank").alias("rank"))
    return best.select("key", F.array("rank.path").alias("paths"))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and the path that was used, for every row of pages."""
    ranks = cut(host_paths(pages))
    sizes = ranks.groupBy("host").agg(F.count("*").alias("k"))
    many = cut(sizes.filter(F.col("k") > LISTED).select("host"))
    n = sizes.count()
    listed = ranks.join(many, "host", "left_anti").groupBy("host").agg(F.sort_array(F.collect_list("rank"), asc=False)["path"].alias("paths"))
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    joined = own.join(F.broadcast(listed) if n <= BROADCAST_HOSTS else listed, "host", "left").select("page_id", "url", "host", "paths", "html")
    if not many.isEmpty():
        # equal pages have equal keys, and take the same path
        keyed = joined.withColumn("key", F.sha2(F.concat_ws("\u0000", "host", "html"), 256))
        large = keyed.join(many, "host", "left_semi")
        chosen = best_paths(large.select("key", "host", "html").distinct(), ranks.join(many, "host", "left_semi"))
        joined = keyed.drop("paths").join(chosen, "key").select("page_id", "url", "host", "paths", "html").union(keyed.join(chosen, "key", "left_anti").select("page_id", "url", "host", "paths", "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths_, pages_ = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            found = [extract_ranked(parse(x), p or []) if x else ("", None) for p, x in zip(paths_, pages_, strict=True)]
            texts, used = [f[0] for f in found], [f[1] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(used, pa.string())],
                names=["page_id", "url", "text", "n_chars", "path"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "paths", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, path string")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
