"""Main text of web pages by equivalence-class template deduction.

1. A page is a sequence of tokens: tags and text nodes, each told apart by its
   path of open elements.  Over the pages of a host a token has an occurrence
   vector, its count on each page.  Vectors are compared by sums over pages of
   a hash of page and count; such sums combine map-side, so no host, however
   large, is gathered anywhere.
2. The pages of a host with main text (in an article or main element) and
   those without are two layouts.  Tokens of one layout with equal vectors form
   an equivalence class.  Classes of ``MIN_CLASS`` tokens on half of the
   layout's pages (``MIN_PAGES`` at least) make its template.  A template is at
   most twice as large as the layout's average page, since each of its tokens
   is on half of them.
3. On each page a class is valid if its tokens come in the template's order, as
   often as they repeat, and nested if each of its occurrences lies within one
   slot of every larger valid class.
4. What is left between the tokens of valid classes are the slots.  Text of
   slots in elements that are not content by name, role or class (menus,
   forms, adverts, reader comments and the like) goes; if the page has an
   article or main element, only text inside counts.  There a div or section
   of which all text is template text goes; other repeated text stays, since a
   title, paragraph or list that many articles share is still the article's,
   and so does a main text without any slot.  Elsewhere template text goes too.

Character references are decoded, white space in a block is one space, blocks
are joined by a line feed, and nothing else is dropped.

Defined cases: null or empty pages give an empty text; hosts of few pages have
no template, their slots follow from the elements alone; a null url is a host
of its own; unclosed elements, comments and scripts end where the page does;
each input row gives one row.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, column, materialise

MIN_PAGES, MIN_CLASS = 3, 3
#: So many of the innermost elements around a text are looked at.
MAX_BOXES = 16

# HTML element names by behaviour.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
            "th thead title tr ul".split())
#: Elements that never hold main text.
IDLE = set("aside button canvas datalist dialog embed footer form head iframe input label menu meter nav noscript object option "
           "progress script select style svg template textarea title".split())
#: An opening of the key ends an open element of the value, up to the nearest container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "tbody": {"thead", "tbody"}, "tfoot": {"tbody"}}
#: Words in class, id or role that mark what is not main text.
IDLE_WORDS = set("ad ads adbox advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
                 "cookies discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices overlay "
                 "popup promo promoted promotion related replies reply respond share sharing sidebar signup skip social sponsor "
                 "sponsored subscribe toolbar widget complementary contentinfo".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S | re.I)
#: One attribute after the other: a name, then its value, so that no name is found inside a value or another name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Their ids are anchors made from a title: inside main text a single word of them marks nothing.
TITLED = set("h1 h2 h3 h4 h5 h6 section article".split())
_NAME_WORD = re.compile(r"[a-z0-9]+")


def _marks(attrs: str, tag: str = "", main: bool = False) -> tuple[str, bool]:
    """The class and id of an element as a path part, and whether they mark it as idle."""
    names, idle = [], False
    for m in _ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key == "hidden":
            idle = True
        elif key in ("class", "id", "role"):
            names.append(value)
            words = [w for w in _NAME_WORD.findall(value) if not w.isdigit()]
            if key == "id" and tag in TITLED and (main or tag == "article"):
                idle = idle or tag in ("section", "article") and bool(words) and IDLE_WORDS.issuperset(words)
            else:
                idle = idle or bool(IDLE_WORDS.intersection(words))
    return ".".join(names), idle


@dataclass(slots=True)
class Token:
    key: str  # path and tag, or path and text
    text: str | None = None  # of a text node, decoded
    block: bool = False  # a block starts or ends here
    space: bool = False  # a line break
    idle: bool = False
    main: bool = False
    boxes: tuple[int, ...] = ()  # of a text node, the div and section elements around it inside main text


@dataclass(slots=True)
class _Open:
    tag: str
    path: str
    idle: bool
    main: bool
    boxes: tuple[int, ...] = ()


def tokenise(page: str) -> list[Token]:
    """Tags and text nodes of a page in order, with the state of the elements around them."""
    stack = [_Open("", "", False, False)]
    out: list[Token] = []
    for m in _TOKEN.finditer(page):
        tag = m["tag"]
        top = stack[-1]
        if tag is None:
            piece = m[0]
            if m["raw"]:
                out.append(Token(f"{top.path}/{m['raw'].lower()}"))
            elif piece[0] != "<" or piece == "<":
                text = entities.unescape(piece) if "&" in piece else piece
                if out and out[-1].text is not None:  # a lone "<" inside a text
                    out[-1].text += text
                    out[-1].key += piece.strip()
                else:
                    out.append(Token(f"{top.path}|{piece.strip()}", text, False, False, top.idle, top.main, top.boxes))
            continue
        tag = tag.lower()
        block = tag in BLOCK
        if m["end"]:
            if tag in VOID:
                continue
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                del stack[depth:]
                out.append(Token(f"{stack[-1].path}/-{tag}", None, block))
            continue
        ends = ENDS.get(tag)
        if ends or block:
            for k in range(len(stack) - 1, 0, -1):
                name = stack[k].tag
                if ends and name in ends or block and name == "p":
                    del stack[k:]
                    break
                if name in ("div", "ul", "ol", "table", "article", "section", "main", "body", "td", "dl", "nav"):
                    break
            top = stack[-1]
        names, marked = _marks(m["attrs"], tag, top.main) if m["attrs"].strip() else ("", False)
        path = f"{top.path}/{tag}.{names}" if names else f"{top.path}/{tag}"
        if tag in ("html", "body", "main"):
            marked = False
        idle = top.idle or marked or tag in IDLE or (tag == "header" and not top.main)
        main = top.main or tag in ("article", "main") and not idle
        out.append(Token(path, None, block, tag == "br"))
        if tag not in VOID and not m["attrs"].endswith("/"):
            boxes = (*top.boxes[-MAX_BOXES + 1:], len(out)) if top.main and tag in ("div", "section") else top.boxes
            stack.append(_Open(tag, path, idle, main, boxes))
    return out


def _hash(key: str, main: bool = False) -> int:
    """A token of one of the two layouts of a host."""
    return xxhash.xxh64_intdigest(key.encode("utf-8", "replace"), seed=int(main)) >> 2 << 1 | main


def _has_main(tokens: list[Token]) -> bool:
    return any(t.main for t in tokens)


@dataclass(slots=True)
class _Seen:
    pages: int = 0
    total: int = 0
    print_a: int = 0
    print_b: int = 0
    place: int = 0


@dataclass(slots=True)
class Template:
    """Token -> (class, rank in its class); class sizes."""

    place: dict[int, tuple[int, int]] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


_STATS = pa.schema([("host", pa.string()), ("token", pa.int64()), ("pages", pa.int64()), ("total", pa.int64()),
                    ("print_a", pa.int64()), ("print_b", pa.int64()), ("place", pa.int64())])
#: The token that stands for the page itself: its count is the host's number of pages.
PAGE_TOKEN = -1
#: The same for the pages with main text.
MAIN_TOKEN = -2


def token_vectors(pages: DataFrame) -> DataFrame:
    """``host, token`` with the digest of its occurrence vector, from ``host, key, html``; one row per task and token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple[str, int], _Seen] = {}
            for host, key, page in zip(column(b, "host"), column(b, "key"), column(b, "html")):
                counts: dict[int, list[int]] = {}
                tokens = tokenise(page) if page else []
                main = _has_main(tokens)
                seen.setdefault((host, MAIN_TOKEN if main else PAGE_TOKEN), _Seen()).pages += 1
                for at, t in enumerate(tokens):
                    if t.text is None or not t.text.isspace():
                        own = counts.setdefault(_hash(t.key, main), [0, at])
                        own[0] += 1
                for token, (n, at) in counts.items():
                    mark = xxhash.xxh64_intdigest(f"{key} {n}")
                    s = seen.setdefault((host, token), _Seen())
                    s.pages += 1
                    s.total += n
                    s.print_a += mark >> 34
                    s.print_b += mark & 0x3FFFFFFF
                    s.place += at * 1_000_000 // len(tokens)
            yield batch_of(_STATS, [k[0] for k in seen], [k[1] for k in seen], *[[getattr(s, f) for s in seen.values()]
                                                                             for f in _Seen.__slots__])

    parts = pages.mapInArrow(run, "host string, token long, pages long, total long, print_a long, print_b long, place long")
    return parts.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in _Seen.__slots__])


def deduce_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS) -> DataFrame:
    """``host, classes``: per host its equivalence classes, each a list of tokens in page order."""
    vectors = materialise(token_vectors(pages).filter((F.col("pages") >= min_pages)), "token_vectors")
    # the last bit of a token is its layout
    hosts = vectors.filter("token < 0").select("host", (F.col("token") == MAIN_TOKEN).cast("long").alias("main"), F.col("pages").alias("host_pages"))
    common = vectors.filter("token >= 0").withColumn("main", F.col("token").bitwiseAND(F.lit(1).cast("long"))) \
        .join(hosts, ["host", "main"]).filter(2 * F.col("pages") >= F.col("host_pages"))
    rank = F.struct((F.col("place") / F.col("pages")).alias("place"), "token")
    classes = common.groupBy("host", "main", "pages", "total", "print_a", "print_b").agg(F.array_sort(F.collect_list(rank)).alias("tokens")) \
        .filter(F.size("tokens") >= min_class)
    return classes.groupBy("host").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("pages")).alias("order"), F.col("tokens.token").alias("tokens")))).alias("classes")) \
        .select("host", F.col("classes.tokens").alias("classes"))


def read_template(classes: list[list[int]] | None) -> Template:
    t = Template()
    for k, tokens in enumerate(classes or []):
        t.sizes.append(len(tokens))
        for rank, token in enumerate(tokens):
            t.place[token] = (k, rank)
    return t


def valid_positions(hashes: list[int], template: Template) -> set[int]:
    """Positions of a page's tokens that belong to classes which are ordered and nested on this page."""
    found: dict[int, list[tuple[int, int]]] = {}
    for at, h in enumerate(hashes):
        where = template.place.get(h)
        if where:
            found.setdefault(where[0], []).append((at, where[1]))
    accepted: list[list[list[int]]] = []
    for k in sorted(found, key=lambda k: (-template.sizes[k], k)):
        size, seq = template.sizes[k], found[k]
        if len(seq) % size or any(rank != i % size for i, (_, rank) in enumerate(seq)):
            continue  # not ordered here
        cycles = [[at for at, _ in seq[i:i + size]] for i in range(0, len(seq), size)]
        if all(_one_slot(c[0], c[-1], other) for c in cycles for other in accepted):
            accepted.append(cycles)
    return {at for cycles in accepted for c in cycles for at in c}


def _one_slot(first: int, last: int, cycles: list[list[int]]) -> bool:
    """No token of ``cycles`` lies between ``first`` and ``last``, or all of each cycle that has one there."""
    for c in cycles:
        inside = sum(first < at < last for at in c)
        if inside and inside != len(c):
            return False
    return True


def main_text(page: str | None, template: Template) -> str:
    """The text of a page's content slots."""
    if not page:
        return ""
    tokens = tokenise(page)
    has_main = _has_main(tokens)
    fixed = valid_positions([_hash(t.key, has_main) for t in tokens], template) if template.sizes else set()
    # elements of the main text that hold text of this page's own; none at all: the whole main text repeats and stays
    slots = [t for at, t in enumerate(tokens) if t.main and not t.idle and at not in fixed and not t.text.isspace()]
    live = {k for t in slots for k in t.boxes}
    blocks, own = [], []
    for at, t in enumerate(tokens):
        if t.text is not None:
            if t.main:
                slot = at not in fixed or not slots or not t.boxes or t.boxes[-1] in live
            else:
                slot = at not in fixed and not has_main
            if slot and not t.idle:
                own.append(t.text)
        elif t.block:
            blocks.append("".join(own))
            own = []
        elif t.space:
            own.append(" ")
    blocks.append("".join(own))
    return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 min_pages: int = MIN_PAGES, min_class: int = MIN_CLASS) -> DataFrame:
    """``id, url, text, n_chars`` for each page."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.concat_ws(" ", F.col(id_col).cast("string"), url_col).alias("key"), F.col(html_col).alias("html"))
    templates = materialise(deduce_templates(rows.select("host", "key", "html"), min_pages, min_class), "templates")
    schema = pa.schema([("id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, template = None, read_template(None)
        for b in batches:
            texts = []
            for classes, page in zip(b.column(b.schema.get_field_index("classes")), column(b, "html")):
                classes = classes.as_py()
                if classes != last:
                    last, template = classes, read_template(classes)
                texts.append(main_text(page, template))
            yield batch_of(schema, b.column(0), b.column(1), texts)

    # one template row per host: Spark broadcasts the table while it is under its size threshold, else splits hot hosts
    joined = rows.join(templates, "host", "left").select("id", "url", "html", "classes")
    out = joined.mapInArrow(run, "id long, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
