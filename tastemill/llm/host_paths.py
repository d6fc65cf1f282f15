"""Main text of web pages by consensus of their host.

Every page scores its containers: text outside boilerplate, less what menus, forms, notices
and links add. The best container's generalised path of tags and classes is the page's vote.
Votes are summed per host in Spark. A page is extracted from the containers at the path it votes for
if another page of its host does so too. A page that stands alone with its path follows its host: of
all voted paths that it has, it takes the one with the most votes times its clean text there; a page
that has none, or has no host, uses its own best one.
What marks boilerplate are tags, roles and names (classes and ids). A name counts by its last word, past words
such as list or wrapper, unless a word such as has or without turns it round; on headings, paragraphs and
other text only plain names of adverts and the like count, on inline elements none. An article or main element
inside a marked element is clean again. Marks are doubted where little else is left: if they cover three quarters of a
page's text, the outermost that holds half of all is void, reader comments only if there is next to nothing
else, and the page is looked at again.
An inner container gets a page's vote in place of the best one only where what it leaves outside has
no clean text, or a little that most such pages of the host have word for word beside other texts.

Null html is empty html and gives an empty text; html of any length is read whole. Ties between paths go to the greater in
order. Columns other than page_id, url and html are ignored whatever their names. Rows that repeat a page_id are pages of
their own. Markup may be broken or cut short: open elements end with the page. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemill.llm.common import join_counted, stage, table

PLAIN_LEVELS = 32  # deeper elements have a hash of their path
LEAST_VOTES = 2  # a path with fewer has one page only
NEARLY_ALL = 0.9  # share of the best container's text from which an inner one can take its place
MOST, HALF, HARDLY = 0.75, 0.5, 0.02  # shares of a page's text at which marks are doubted, an element is void, comments too
HOST_BROADCAST = 100_000  # rows of (host, page, path) that a broadcast may hold

# Tag names of HTML and words of boilerplate classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What these hold is no markup, up to their end tag or the page's end.
RAW = {t: re.compile(rf"</{t}(?![^\s/>])", re.I | re.A) for t in "script style textarea title iframe".split()}
HIDDEN = frozenset("noscript template svg math object select option datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span strike strong "
    "sub sup time tt u var label".split()
)
CONTAINERS = frozenset("article main section div td body".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset".split())
FIRM_TAGS = frozenset("nav menu dialog button".split())
COMMENT_WORDS = frozenset("comment comments discussion disqus replies reply".split())
ADVERT_WORDS = frozenset(
    "ad ads adv advert advertisement advertising adverts breadcrumb breadcrumbs consent cookie cookies gdpr newsletter "
    "pagination promo promotion share sharing signup sponsor sponsored subscribe".split()
)
BOILERPLATE_WORDS = COMMENT_WORDS | ADVERT_WORDS | frozenset(
    "banner dialog footer form header login masthead menu modal nav navbar navigation notice notification notices overlay "
    "popup related search sidebar skip social toolbar widget".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
# Words behind the one that says what an element is, words that turn it round, and words before a header that is content.
TAIL_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content count group heading holder icons inner item "
    "items label left link links list message outer panel posts region right row section slot text thread title top unit "
    "widget widgets wrap wrapper zone".split()
)
TURNING_WORDS = frozenset("has have hide is no not show with without".split())
CONTENT_WORDS = frozenset("article content entry main page post section story title".split())
TOPICS = frozenset("dialog discussion form notice related reply search social".split())  # of a section of an article
# Elements of running text, where words such as dialog or notice are about the text.
TEXT_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figure figcaption table tr td th address hr".split()
)
# An opening tag on the left is ended by any of those on the right.
ENDED_BY = {
    "p": frozenset(
        "p div ul ol dl table section article main aside header footer nav form h1 h2 h3 h4 h5 h6 pre blockquote hr "
        "fieldset address figure".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "select", "datalist"]),
}
# These hold no blocks; an opening block ends them.
WITHOUT_BLOCKS = ("svg", "math", "select", "datalist", "option")
HTML_INSIDE = ("foreignobject", "annotation-xml", "desc")  # elements of svg and math that do hold them
PIECE = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<loose>[a-zA-Z][^\s/>]*)(?P<loose_attrs>[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![^\s\"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
SPLIT = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"[0-9]+")


@dataclass
class Mark:
    """A marked element; ``firm`` is the nearest mark at or above it that an article inside doesn't end."""

    kind: str  # hidden, firm, comment or doubtful
    above: Mark | None
    firm: Mark | None = None
    junk: bool = True
    size: int = 0  # characters inside

    def __post_init__(self):
        if self.kind != "doubtful":
            self.firm = self
        elif self.above is not None:
            self.firm = self.above.firm


@dataclass
class Node:
    tag: str
    path: str
    level: int
    at: int  # in the stack of open elements
    mark: Mark | None  # the nearest mark at or above
    link: bool
    container: Node | None  # the nearest container, itself included
    above: Node | None = None  # the next container above it
    content: bool = False  # an article or main element is open

    @property
    def junk(self) -> bool:
        return self.mark is not None and self.mark.junk


def _marked_by(name: str, tag: str, inside: bool) -> str:
    """The word by which a class or id marks boilerplate, or an empty one."""
    words = [w for w in SPLIT.split(CAMEL.sub(" ", name).lower()) if w]
    last = len(words) - 1
    while last > 0 and words[last] in TAIL_WORDS:
        last -= 1
    if last < 0 or not TURNING_WORDS.isdisjoint(words[:last]):
        return ""
    word = words[last]
    if word not in (ADVERT_WORDS if tag in TEXT_TAGS else BOILERPLATE_WORDS):
        return ""
    if tag == "section" and inside and word in TOPICS:
        return ""
    # The header of an article is its title; a body of content is none.
    if word == "header" and (inside or not CONTENT_WORDS.isdisjoint(words[:last])):
        return ""
    return word


def _described(attrs: str, tag: str, inside: bool) -> tuple[str, str]:
    """The generalised classes and what kind of boilerplate class, id or role mark: hidden, comment, doubtful or none."""
    classes, kind = "", ""
    for name, *values in ATTRIBUTE.findall(attrs):
        value = entities.unescape(next((v for v in values if v), ""))
        name = name.lower()
        if name in ("class", "id"):
            if tag not in INLINE and kind not in ("hidden", "comment"):
                for word in (_marked_by(n, tag, inside) for n in value.split()):
                    if word:
                        kind = "comment" if word in COMMENT_WORDS else kind or "doubtful"
            if name == "class":
                classes = ".".join(["", *sorted({DIGITS.sub("0", c.lower()) for c in value.split()})])
        elif name == "role":
            if value.lower() in BOILERPLATE_ROLES:
                kind = kind or "doubtful"
        elif name == "hidden" or value.lower() == "true":
            kind = "hidden"
    return classes, kind


def _step(above: str, level: int, tag: str, classes: str) -> str:
    path = f"{above}>{tag}{classes}"
    if level <= PLAIN_LEVELS:
        return path
    return "#" + hashlib.blake2b(path.encode("utf-8", "replace"), digest_size=16).hexdigest()


class _Open:
    """The open elements, with the places of each tag and of the blocks among them."""

    def __init__(self):
        self.stack = [Node("", "", 0, 0, None, False, None)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def last(self, *tags: str) -> int:
        """The place of the last open element with one of the tags, 0 without any."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(node.at)
        if node.tag not in INLINE:
            self.blocks.append(node.at)
        self.stack.append(node)

    def cut(self, at: int) -> None:
        """Close all elements from a place on."""
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()


def parse(page: str) -> list[tuple[Node, str]]:
    """The page's text runs in order, each with its element; breaks between blocks are runs of one space."""
    opened, runs, at, end = _Open(), [], 0, len(page)
    stack, marks = opened.stack, []
    while at < end:
        found = PIECE.search(page, at)
        start = found.start() if found else end
        if start > at:
            runs.append((stack[-1], entities.unescape(page[at:start])))
        if not found:
            break
        at = found.end()
        if found["close"]:
            tag = found["close"].lower()
            depth = opened.last(tag)
            if tag not in INLINE:
                runs.append((stack[-1], " "))
            elif depth and opened.blocks and opened.blocks[-1] > depth:
                depth = 0  # a stray end of an inline element doesn't end the blocks inside it
            if depth:
                opened.cut(depth)
            continue
        tag = (found["open"] or found["loose"] or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            runs.append((stack[-1], " "))
        if tag in VOID:
            continue
        attrs = found["attrs"] or found["loose_attrs"] or ""
        if tag in RAW:
            if not attrs.endswith("/"):
                close = RAW[tag].search(page, at)
                at = close.start() if close else end
            continue
        if tag in HIDDEN and attrs.endswith("/"):
            continue
        if tag in ENDED_BY["p"]:
            least = opened.last(*HTML_INSIDE)
            outer = min((next(p for p in opened.places[t] if p > least) for t in WITHOUT_BLOCKS if opened.last(t) > least), default=0)
            if outer:
                opened.cut(outer)
        if opened.blocks and tag in ENDED_BY.get(stack[opened.blocks[-1]].tag, ()):
            opened.cut(opened.blocks[-1])
        above = stack[-1]
        main = tag in ("article", "main")
        classes, kind = _described(attrs, tag, above.content) if attrs else ("", "")
        if tag in HIDDEN:
            kind = "hidden"
        elif tag in FIRM_TAGS:
            kind = kind or "firm"
        elif tag in BOILERPLATE_TAGS:
            titled = tag == "header" and (above.content or not CONTENT_WORDS.isdisjoint(SPLIT.split(classes)))
            kind = kind or ("" if titled else "doubtful")
        elif tag in ("html", "body") or main and kind == "doubtful":
            kind = kind if kind == "hidden" and tag not in ("html", "body") else ""
        mark = above.mark
        if main and mark is not None and mark.kind != "hidden":
            mark = mark.firm
        if kind:
            mark = Mark(kind, mark)
            marks.append(mark)
        level = above.level + 1
        node = Node(
            tag, _step(above.path, level, tag, classes), level, len(stack), mark, above.link or tag == "a", above.container,
            content=above.content or main,
        )
        if tag in CONTAINERS:
            node.container = node
            node.above = above.container
        opened.push(node)
    _doubt(runs, marks)
    return runs


def _doubt(runs: list[tuple[Node, str]], marks: list[Mark]) -> None:
    """Void the marks of elements that hold what the page is about; marks come outer ones first."""
    total = clean = 0
    for node, text in runs:
        firm = node.mark.firm if node.mark is not None else None
        if not node.link and not text.isspace() and (firm is None or firm.kind != "hidden"):
            total += len(text)
            if node.mark is None:
                clean += len(text)
            else:
                node.mark.size += len(text)
    for mark in reversed(marks):
        if mark.above is not None:
            mark.above.size += mark.size
    doubted = clean < (1 - MOST) * total
    for mark in marks:
        if mark.above is not None and mark.above.junk:
            continue
        bar = {"doubtful": HALF * total, "comment": max(HALF, 1 - HARDLY) * total}.get(mark.kind)
        mark.junk = not (doubted and bar is not None and mark.size >= bar)


def _holders(runs: list[tuple[Node, str]]) -> list[Node]:
    """The containers that hold the runs, outer ones first."""
    found: dict[int, Node] = {}
    for node, _ in runs:
        holder = node.container
        while holder is not None and id(holder) not in found:
            found[id(holder)] = holder
            holder = holder.above
    return sorted(found.values(), key=lambda n: n.level)


def _containers(runs: list[tuple[Node, str]]) -> dict[str, list[int]]:
    """Clean and wasted characters of the containers, by path."""
    own: dict[int, list[int]] = {}
    texts = [(node, text) for node, text in runs if node.container is not None and text and not text.isspace()]
    for node, text in texts:
        own.setdefault(id(node.container), [0, 0])[node.junk or node.link] += len(text)
    found: dict[str, list[int]] = {}
    for holder in reversed(_holders(texts)):
        clean, waste = own.get(id(holder), (0, 0))
        if holder.junk:
            if holder.above is not None:
                own.setdefault(id(holder.above), [0, 0])[0] += clean
                own[id(holder.above)][1] += waste
            continue
        sums = found.setdefault(holder.path, [0, 0, holder.level, holder.tag in ("article", "main")])
        sums[0] += clean
        sums[1] += waste
        if holder.above is not None:
            outer = own.setdefault(id(holder.above), [0, 0])
            outer[0] += clean
            outer[1] += waste
    return found


def _inside(runs: list[tuple[Node, str]], path: str) -> set[int]:
    """The ids of the containers at a path and inside those."""
    found: set[int] = set()
    for holder in _holders(runs):
        if (holder.path == path and not holder.junk) or id(holder.above) in found:
            found.add(id(holder))
    return found


def _best(sums: dict[str, list[int]]) -> tuple[str, int]:
    score, _, path = max(
        ((clean - 2 * waste) * (5 if main else 4), level, path) for path, (clean, waste, level, main) in sums.items()
    )
    return path, max(score // 4, 0)


def best_container(page: str) -> tuple[str, int] | None:
    """The path and score of the page's best container; ties go to the deeper one.

    So a container inside that holds all its clean text is better, and none that holds less.
    """
    sums = _containers(parse(page))
    return _best(sums) if sums else None


def _digest(texts: list[str]) -> str:
    return hashlib.blake2b(" ".join("".join(texts).split()).encode("utf-8", "replace"), digest_size=16).hexdigest()


def vote_of(page: str) -> dict | None:
    """The best container's path and, if an inner one holds nearly all its text, that one's path.

    Then ``rest`` and ``body`` stand for the clean text outside and inside the inner one.
    """
    runs = parse(page)
    sums = _containers(runs)
    if not sums:
        return None
    path, _ = _best(sums)
    vote = {"path": path}
    clean, _, _, main = sums[path]
    near = []
    if not main:
        within = _inside(runs, path)
        inner = {n.path for n in _holders(runs) if id(n) in within and n.path != path and not n.junk}
        near = [(v[0], v[2], p) for p, v in sums.items() if p in inner and NEARLY_ALL * clean <= v[0] < clean]
    if near:
        inner = max(near)[2]
        rest, body, deeper = [], [], _inside(runs, inner)
        for node, text in runs:
            if not node.junk and not node.link and id(node.container) in within:
                (body if id(node.container) in deeper else rest).append(text)
        vote |= {"inner": inner, "rest": _digest(rest), "body": _digest(body)}
    return vote


def main_text(page: str, paths: list[str]) -> str:
    """Text of the containers at the first path that the page has, without boilerplate."""
    runs = parse(page)
    sizes = _containers(runs)
    path = next((p for p in paths if sizes.get(p, [0])[0]), None)
    if path is None and sizes:
        path, _ = _best(sizes)
    within = None if path is None else _inside(runs, path)
    inside: list[str] = []
    last = None
    for node, text in runs:
        if node.junk:
            if last is not node:
                inside.append(" ")
        elif within is None or id(node.container) in within:
            inside.append(text)
        last = node
    return " ".join("".join(inside).split())


def seen(pages: DataFrame) -> DataFrame:
    """What every page with a host votes for, staged; a page without text in a container has null paths."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([(n, pa.string()) for n in ("host", "page", "path", "inner", "rest", "body")])
        for batch in batches:
            found = [{"host": h.as_py(), "page": k.as_py()} | (vote_of(p.as_py()) or {}) for h, k, p in zip(*batch.columns)]
            yield pa.RecordBatch.from_pylist(found, schema=kinds)

    return stage(
        pages.where(F.col("host").isNotNull()).select("host", "page", "html").mapInArrow(
            vote, "host string, page string, path string, inner string, rest string, body string"
        ), "host-pages",
    )


def templates(cast: DataFrame) -> DataFrame:
    """(host, path, inner, rest, votes): where most pages leave the same text outside the inner container.

    A page counts once however often it is repeated, so copies don't make their title a template's text.
    """
    by_rest = cast.where("inner IS NOT NULL").groupBy("host", "path", "inner", "rest").agg(
        F.count(F.lit(1)).alias("votes"), F.count_distinct("body").alias("bodies")
    )
    most = F.max(F.struct("bodies", "rest", "votes")).alias("most")
    by_inner = by_rest.groupBy("host", "path", "inner").agg(F.sum("bodies").alias("pages"), most)
    same = (F.col("most.bodies") >= LEAST_VOTES) & (2 * F.col("most.bodies") > F.col("pages"))
    return by_inner.where(same).select("host", "path", "inner", "most.rest", "most.votes")


def votes(cast: DataFrame, same: DataFrame) -> DataFrame:
    """(host, path, votes, page) over all pages that have a container with text; page is one of the voters."""
    keys = ["host", "path", "inner", "rest"]
    sums = cast.where("path IS NOT NULL").groupBy(*keys).agg(F.count(F.lit(1)).alias("votes"), F.min("page").alias("page"))
    met = sums.join(same.select(*keys, F.lit(True).alias("same")), keys, "left")
    own = met.withColumn("path", F.when(F.col("same"), F.col("inner")).otherwise(F.col("path")))
    return own.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.min("page").alias("page"))


def _meet(rows: DataFrame, keyed: DataFrame, cast: DataFrame) -> DataFrame:
    """The rows with what a staged table says of their (host, page), nulls where it has none."""
    keys = ["host", "page"]
    if keyed.count() <= HOST_BROADCAST:  # a checked size; the joins give the same rows
        return rows.join(F.broadcast(keyed), keys, "left")
    copies = cast.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).join(keyed, keys, "left")
    met = join_counted(rows, copies, keys, "copies", cast.count()).drop("copies")
    return met.unionByName(rows.where("host IS NULL"), allowMissingColumns=True)


def followers(rows: DataFrame, cast: DataFrame, voted: DataFrame) -> DataFrame:
    """(host, page, path): the host's path for each page that stands alone with its own and has another's."""

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("host", pa.string()), ("page", pa.string()), ("path", pa.string()), ("clean", pa.int64())])
        for batch in batches:
            for h, k, p in zip(*batch.columns):
                found = [(path, v[0]) for path, v in _containers(parse(p.as_py())).items() if v[0]]
                yield pa.RecordBatch.from_pylist(
                    [{"host": h.as_py(), "page": k.as_py(), "path": path, "clean": clean} for path, clean in found], schema=kinds
                )

    common = voted.where(F.col("votes") >= LEAST_VOTES)
    alone = voted.where(F.col("votes") < LEAST_VOTES).select("host", "page")
    hosts = voted.groupBy("host").agg(
        F.count_if(F.col("votes") < LEAST_VOTES).alias("lone"), F.count_if(F.col("votes") >= LEAST_VOTES).alias("shared")
    ).where("lone > 0 AND shared > 0")
    alone = join_counted(alone, hosts, ["host"], "lone", alone.count()).select("host", "page", F.lit(True).alias("alone"))
    lone = _meet(rows, stage(alone, "host-alone"), cast).where("alone").select("host", "page", "html")
    held = stage(lone.mapInArrow(hold, "host string, page string, path string, clean long"), "host-held")
    met = held.groupBy("host", "path").agg(F.count(F.lit(1)).alias("held")).join(common.drop("page"), ["host", "path"])
    met = join_counted(held, met, ["host", "path"], "held", held.count())
    best = F.max(F.struct(F.col("votes") * F.col("clean"), "votes", "path"))
    return met.groupBy("host", "page").agg(best["path"].alias("path"))


def choices(rows: DataFrame, cast: DataFrame) -> DataFrame:
    """(host, page, path) of the pages that are not read from their own best container, staged."""
    same = stage(templates(cast), "host-templates")
    voted = stage(votes(cast, same), "host-votes")
    inward = join_counted(cast, same, ["host", "path", "inner", "rest"], "votes", cast.count())
    inward = inward.select("host", "page", F.col("inner").alias("path")).distinct()
    return stage(inward.unionByName(followers(rows, cast, voted)), "host-choices")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    rows = rows.withColumn("page", F.sha2("html", 256))  # what is chosen depends on the host and the html only
    cast = seen(rows)
    met = _meet(rows, choices(rows, cast), cast)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), [path.as_py()]) for p, path in zip(batch.column(2), batch.column(3))]
            sizes = [len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    ids = pages.schema["page_id"].dataType.simpleString()
    return met.select("page_id", "url", "html", "path").mapInArrow(read, f"page_id {ids}, url string, text string, n_chars long")


def op3_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
