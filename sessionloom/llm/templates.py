"""Main text of web pages by templates deduced from the pages of a host.

The tokens of a page are its opening and closing tags, told apart by their path
of elements, classes and ids, and its runs of text, told apart by path and
wording.  A token's occurrence vector says how often it stands on each page of
the host.  Tokens with one vector form an equivalence class.  A class is valid
if its tokens stand in one order on every page and its occurrences do not
overlap those of other classes, so valid classes nest into the host's template.
What is left between template tokens are slots; the text of those that hold the
article is the main text.

A vector is never gathered: two sums of hashes of (page, count) stand for it, so
the pages of a host are added up in any order and in as many tasks as there are.
Words are not tokens of their own: common words have equal counts on a few
pages by chance, and would take parts of articles with them.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.lineage import cut
from .arrow import schema_of

FREQUENT = 0.5  # a class counts when it stands on this share of the host's pages
FEWEST = 8  # different pages a host needs before its constant texts are template text

# --- fixed values: elements and names ----------------------------------------

INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea xmp iframe noembed noframes".split())
# opening one of these ends a paragraph
ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
# opening one of these ends an open one of the named, up to the named border
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
# never part of an article
OUT = set("head nav aside footer form noscript template button select datalist dialog menu object svg canvas audio video search".split())
OUT_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form status".split())
OUT_WORDS = set(
    "ad ads advert adverts advertisement advertisements adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "copyright dialog disclaimer discussion disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices notification overlay pager paging pagination popup promo promoted promotion reactions recommended related replies reply respond "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
# text lies in one of these, or in a part of one
CONTAINERS = set("article body center div html main section td".split())

_MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)", re.S
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d{2,}")  # numbers of pages and entries, not of columns
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for n in RAW}
_ROOT = 0x9E3779B97F4A7C15
_CLOSE = 0x5851F42D4C957F2D


def _hash(parent: int, what: str) -> int:
    return xxhash.xxh3_64_intdigest(what.encode("utf-8", "surrogatepass"), parent)


class Run:
    """A run of text between two ends of blocks."""

    __slots__ = ("chars", "container", "hint", "inside", "links", "out", "scope", "text", "token")


def parse(page: str, skeleton=None, container: int | None = None) -> tuple[list[int], list[Run]]:
    """Tokens in page order, and the runs of text.

    A run's container is its innermost container whose opening tag is in
    ``skeleton`` (any, without one); ``inside`` says whether it lies in the one
    with the path ``container``.  Time is proportional to the length of the page.
    """
    tokens: list[int] = []
    runs: list[Run] = []
    pieces: list[str] = []
    links = 0
    in_link = False
    # name, path, left out, hint, 2 in an article or 1 in a main part, container, inside
    stack: list[tuple] = [("", _ROOT, False, None, 0, _ROOT, container == _ROOT)]
    open_names: Counter = Counter()

    def flush() -> None:
        nonlocal pieces, links
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                _, path, out, hint, scope, held, inside = stack[-1]
                r = Run()
                r.text, r.chars, r.links, r.token = text, len(text), min(links, len(text)), _hash(path, "=" + text)
                r.out, r.hint, r.scope, r.container, r.inside = out, hint, scope, held, inside
                runs.append(r)
                tokens.append(r.token)
            pieces, links = [], 0

    def pop() -> str:
        top = stack.pop()
        open_names[top[0]] -= 1
        tokens.append(top[1] ^ _CLOSE)
        return top[0]

    def words(piece: str) -> None:
        nonlocal links
        if piece:
            piece = entities.unescape(piece) if "&" in piece else piece
            pieces.append(piece)
            if in_link:
                links += len(piece)

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        words(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if m[2] is None:  # comment or declaration
            continue
        name, closing = m[2].lower(), bool(m[1])
        if name in INLINE:
            if name == "a":
                in_link = not closing
            continue
        if name == "br" or name == "wbr" or name == "img":
            if name == "br":
                pieces.append(" ")
            continue
        flush()
        if closing:
            in_link = False
            if open_names[name]:
                while pop() != name:
                    pass
            continue
        if name in ENDS_P and open_names["p"]:
            while pop() != "p":
                pass
        elif name in ENDS:
            ended, border = ENDS[name]
            k = len(stack) - 1
            while k > 0 and stack[k][0] not in ended and stack[k][0] not in border and (stack[k][0] in ("div", "p", "address") or name in ("tr", "td", "th")):
                k -= 1
            if k > 0 and stack[k][0] in ended:
                while len(stack) > k:
                    pop()
        attributes = {n.lower(): a or b or c for n, a, b, c in _NAMED.findall(m[3])} if m[3] else {}
        shape = name
        if attributes:
            label = f"{' '.join(sorted(attributes.get('class', '').split()))}#{attributes.get('id', '')}"
            shape = f"{name}.{_DIGITS.sub('0', label)}"
        parent = stack[-1]
        path = _hash(parent[1], shape)
        tokens.append(path)
        if name in VOID:
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            tokens.append(path ^ _CLOSE)
            continue
        _, _, out, hint, scope, held, inside = parent
        if name == "article":
            out, scope = out or scope == 2, 2
        elif name == "main" or attributes.get("role", "").lower() == "main":
            scope = max(scope, 1)
        elif name == "header":
            out = out or scope == 0
        out = out or name in OUT or attributes.get("role", "").lower() in OUT_ROLES or bool(m[3] and _HIDDEN.search(_NAMED.sub("", m[3])))
        if name in ("article", "main") and not out:
            while hint is not None and not hint[0]:  # what holds an article is no advert, whatever it is called
                hint[0], hint = True, hint[1]
            hint = parent[3]
        elif attributes and name not in ("html", "body"):
            named = {w.lower() for w in _WORDS.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")}
            if named & OUT_WORDS:
                hint = [False, hint]
        if name in CONTAINERS and (skeleton is None or path in skeleton):
            held = path
        stack.append((name, path, out, hint, scope, held, inside or path == container))
        open_names[name] += 1
    flush()
    while len(stack) > 1:
        pop()
    return tokens, runs


def left_out(run: Run) -> bool:
    hint = run.hint
    while hint is not None:
        if not hint[0]:
            return True
        hint = hint[1]
    return run.out


def order_of(tokens: list[int], class_of: dict[int, int], sizes: list[int], texts: set[int]) -> dict[int, tuple[tuple[int, ...], frozenset] | None]:
    """For every class on the page the order of its nested tokens and the loose ones, or None where the order breaks.

    A tag that stands inside an occurrence of another class, which began within
    its own class's occurrence, has another role there; it is loose and no part
    of the template.  A run of ``texts`` has its place by its path already.
    """
    orders: dict[int, list[int]] = {}
    loose: dict[int, set[int]] = {}
    broken: set[int] = set()
    opened: dict[int, list[int]] = {}
    stack: list[list[int]] = []  # class, place in its order, tokens that have come
    for t in tokens:
        c = class_of.get(t)
        if c is None or c in broken:
            continue
        order, off = orders.setdefault(c, []), loose.setdefault(c, set())
        if c not in opened:
            opened[c] = [c, 0, 0]
            stack.append(opened[c])
        one = opened[c]
        one[2] += 1
        if stack[-1] is not one and t not in texts:
            good = t not in order
            off.add(t)
        else:
            k = one[1]
            if k == len(order) and t not in order:
                order.append(t)
            good = k < len(order) and order[k] == t and t not in off
            one[1] += 1
        if one[2] == sizes[c] or not good:
            del opened[c]
            stack = stack[:-1] if stack[-1] is one else [x for x in stack if x is not one]
            if not good or one[1] != len(order):
                broken.add(c)
    broken |= set(opened)
    return {c: None if c in broken else (tuple(o), frozenset(loose[c])) for c, o in orders.items()}


def main_runs(page: str, fixed: set[int], skeleton: set[int] | None, container: int | None) -> list[Run]:
    """The runs that hold the article, without template text."""
    _, runs = parse(page, skeleton, container)
    kept = [r for r in runs if not left_out(r)]
    for scope in (2, 1):
        if any(r.scope == scope for r in kept):
            kept = [r for r in kept if r.scope == scope]
            break
    else:
        if kept and not any(r.inside for r in kept):
            mass = masses(kept)
            best = max(mass, key=lambda c: (mass[c], c))
            kept = [r for r in parse(page, skeleton, best)[1] if not left_out(r)]
        kept = [r for r in kept if r.inside and 2 * r.links <= r.chars]
    varying = [r for r in kept if r.token not in fixed]
    return varying or kept


def masses(runs: list[Run]) -> Counter:
    """Characters of text in each container; links count against it."""
    mass: Counter = Counter()
    for r in runs:
        mass[r.container] += r.chars - 2 * r.links
    return mass


def host_of(url: Column) -> Column:
    """Hash of the lower-case host of an address, null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(F.length(host) > 0, F.xxhash64(host))


def _signed(x) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VECTOR = "host long, kind int, token long, n long, low long, high long"


def _vectors(pages: DataFrame) -> DataFrame:
    """(host, kind, token): pages it stands on and two sums that stand for its occurrence vector.

    Kind 0 are tags, kind 1 runs of text, kind 2 whole pages.
    """
    schema = schema_of(_VECTOR)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            hosts, kinds, tokens, counts, owners = [], [], [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen, runs = parse(page)
                texts = {r.token for r in runs}
                me = _hash(_ROOT, page)
                for t, c in [*Counter(seen).items(), (me, 1)]:
                    tokens.append(t)
                    counts.append(c)
                kinds += [int(t in texts) for t in Counter(seen)] + [2]
                more = len(tokens) - len(hosts)
                hosts += [host] * more
                owners += [me] * more
            if not tokens:
                continue
            host, kind, token = np.array(hosts, np.int64), np.array(kinds, np.int32), _signed(tokens)
            mark = _mixed(np.array(owners, np.uint64) + _mixed(np.array(counts, np.uint64)))
            by = np.lexsort((token, kind, host))
            host, kind, token, mark = host[by], kind[by], token[by], mark[by]
            new = np.flatnonzero(np.concatenate(([True], (host[1:] != host[:-1]) | (kind[1:] != kind[:-1]) | (token[1:] != token[:-1]))))
            low, high = (mark & np.uint64(0xFFFFFFFF)).astype(np.int64), (mark >> np.uint64(32)).astype(np.int64)
            n = np.diff(np.concatenate((new, [len(host)])))
            columns = [host[new], kind[new], token[new], n, np.add.reduceat(low, new), np.add.reduceat(high, new)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    sums = [F.sum(c).alias(c) for c in ("n", "low", "high")]
    return cut(pages.mapInArrow(run, schema).groupBy("host", "kind", "token").agg(*sums))


def _classes(vectors: DataFrame) -> DataFrame:
    """host, classes: candidates of at least two tokens that stand on a frequent share of the host's pages.

    A host's row has at most 1 / FREQUENT times the tokens of an average page.
    """
    # written first, so that its size is known and a few hosts do not gather all tokens by host
    hosts = cut(vectors.where("kind = 2").groupBy("host").agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("different")))
    often = vectors.where("kind < 2").join(hosts, "host").where((F.col("different") > 1) & (F.col("n") >= F.col("pages") * FREQUENT))
    constant = (F.col("n") == F.col("pages")) & (F.col("different") >= FEWEST)
    same = often.groupBy("host", "n", "low", "high").agg(
        F.sort_array(F.collect_list("token")).alias("tokens"),
        F.sort_array(F.collect_list(F.when((F.col("kind") == 1) & constant, F.col("token")))).alias("texts"),
    )
    named = same.where(F.size("tokens") > 1).select("host", F.xxhash64("n", "low", "high").alias("class"), "tokens", "texts")
    return cut(named.groupBy("host").agg(F.collect_list(F.struct("class", "tokens", "texts")).alias("classes")))


_REPORT = "host long, class long, token long, container long, first long, last long, mass long"


def _reports(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """Per class the smallest and largest hash of its order (0: broken) and its loose tokens, per container its mass of text."""
    schema = schema_of(_REPORT)
    arrow = to_arrow_schema(schema)

    def run(batches):
        known = _Hosts()
        for batch in batches:
            ends: dict[tuple, tuple] = {}
            off: set[tuple] = set()
            mass: Counter = Counter()
            hosts = batch.column(0).to_pylist()
            for i, page in enumerate(batch.column(1).to_pylist()):
                names, class_of, sizes, skeleton = known.of(hosts[i], batch.column(2), i, _read_classes)
                tokens, runs = parse(page, skeleton)
                for c, found in order_of(tokens, class_of, sizes, {r.token for r in runs}).items():
                    key, code = (hosts[i], names[c]), 0
                    if found is not None:
                        code = _hash(_ROOT, repr((found[0], sorted(found[1])))) >> 1 | 1
                        off |= {(*key, t) for t in found[1]}
                    a, b = ends.get(key, (code, code))
                    ends[key] = (min(a, code), max(b, code))
                if not any(r.scope for r in runs):
                    for c, x in masses([r for r in runs if not left_out(r)]).items():
                        mass[(hosts[i], c)] += x
            rows = [(h, c, None, None, a, b, None) for (h, c), (a, b) in ends.items()]
            rows += [(h, c, int(_signed([t])[0]), None, None, None, None) for h, c, t in off]
            rows += [(h, None, None, int(_signed([c])[0]), None, None, x) for (h, c), x in mass.items()]
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    met = pages.join(classes, "host").select("host", "html", "classes").mapInArrow(run, schema)
    return cut(met.groupBy("host", "class", "token", "container").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("mass").alias("mass")))


class _Hosts:
    """What the rows of a host share, read once; forgotten when many hosts have been met."""

    def __init__(self, most: int = 512):
        self.held, self.most = {}, most

    def of(self, host, column, i: int, read):
        if host not in self.held:
            if len(self.held) >= self.most:
                self.held.clear()
            self.held[host] = read(column[i].as_py())
        return self.held[host]


def _unsigned(tokens: list[int]) -> list[int]:
    return [t & 0xFFFFFFFFFFFFFFFF for t in tokens]


def _read_classes(classes: list[dict]):
    class_of = {t: k for k, c in enumerate(classes) for t in _unsigned(c["tokens"])}
    return [c["class"] for c in classes], class_of, [len(c["tokens"]) for c in classes], set(class_of)


def _read_template(row: dict | None):
    if row is None:
        return set(), None, None
    best = row["container"]
    return set(_unsigned(row["texts"])), set(_unsigned(row["tokens"])), None if best is None else best & 0xFFFFFFFFFFFFFFFF


def templates(pages: DataFrame) -> DataFrame:
    """host, template (tokens and constant texts of valid classes, container of the article) of pages with host and html."""
    classes = _classes(_vectors(pages))
    reports = _reports(pages, classes)
    valid = reports.where("class IS NOT NULL AND first = last AND first <> 0").select("host", "class")
    loose = reports.where("token IS NOT NULL").groupBy("host", "class").agg(F.collect_list("token").alias("loose"))
    each = classes.select("host", F.explode("classes").alias("c")).select("host", "c.*").join(valid, ["host", "class"]).join(loose, ["host", "class"], "left")
    each = each.withColumn("tokens", F.when(F.col("loose").isNull(), F.col("tokens")).otherwise(F.array_except("tokens", "loose")))
    nested = each.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"), F.flatten(F.collect_list("texts")).alias("texts"))
    mass = reports.where("class IS NULL AND mass > 0")
    best = mass.groupBy("host").agg(F.max(F.struct("mass", "container"))["container"].alias("container"))
    found = nested.join(best, "host", "full_outer")
    none = F.array().cast("array<long>")
    row = F.struct(F.coalesce("tokens", none).alias("tokens"), F.coalesce("texts", none).alias("texts"), "container")
    return cut(found.select("host", row.alias("template")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row.

    The text are the article's blocks in page order, with character references
    decoded and white space (any of Unicode) turned into single blanks.  The
    article is what ``article`` elements hold, else ``main`` elements, else the
    container of the host's template with most text outside links; elements,
    roles and names that never are part of an article are left out, and so are
    texts that all pages of a host with at least FEWEST different pages share in
    one place (unless nothing else would stay).

    Null html is empty; empty pages have an empty text.  Pages without a host,
    and hosts with one page, have no template and go by their own page alone.
    Repeated rows are rows of their own; equal pages are one page to the
    template.  Only the three named columns are read.  An empty table gives none.
    """
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")
    ).withColumn("host", host_of(F.col("url")))
    found = templates(rows.where("host IS NOT NULL").select("host", "html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    schema = schema_of(f"page_id {id_type}, url string, text string, n_chars long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        known = _Hosts()
        for b in batches:
            hosts = b.column(3).to_pylist()
            texts = []
            for i, page in enumerate(b.column(2).to_pylist()):
                fixed, skeleton, container = known.of(hosts[i], b.column(4), i, _read_template)
                texts.append(" ".join([r.text for r in main_runs(page, fixed, skeleton, container)]))
            columns = [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return rows.join(found, "host", "left").select("page_id", "url", "html", "host", "template").mapInArrow(run, schema)
