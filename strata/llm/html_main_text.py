"""Main text of web pages with a site style tree (operator 2).

The whole element trees of a host's pages are merged, menus, footers and forms as any other element: an element
is known by its path of tags, classes and ids from the body. For every merged element two entropies are kept over the host's pages: of its
presentation (the sequence of child elements it shows) and of its contents (the texts directly in it).
Menus, adverts and notices look and read alike on many pages and score low; an element's composite
importance combines its own presentation with its children's importance, bottom up. Branches of low
importance are removed from every page of the host.

Three guards keep main text whole: an element shown on fewer than ``MIN_PAGES`` pages proves nothing (full
importance, never removed); a branch is not removed while any text in it varies (by the entropy of its contents,
in an ``article`` as elsewhere); and pages prove a branch a template only as far as they differ outside of it
(copies of one article make it look like a template): the entropy of the other texts of its pages, those of
``MIN_TEXT`` characters and more, must be that of ``MIN_PAGES`` different pages.

What the tree cannot tell goes by what it declares to be: reader comments and rotating adverts, whose texts vary,
and anything on hosts of few pages. Elements that declare themselves (nav, header, footer, aside, form, classes
such as ``ad`` or ``comments``) go on any host, and where a page has an ``article`` or ``main`` that is not removed,
only its text is taken; ``declared=False`` leaves both rules out and the tree decides alone. A declared element
weighs in its parent's importance, but its varying texts and its presence do not vouch for the text around it.

Scale: texts leave the tasks as hashes and counts, aggregated per (host, path, text) with partial
sums, so a hot host spreads over its texts. Elements that prove nothing are summed up under their parent. A host
of up to ``GROUP`` others is scored in one group and its removed paths join its pages as one list. The rest are
scored from the deepest elements up, one join on (host, path) per depth, and their removed paths join the paths
of each page, so no task holds a host; the same rules hold for both.

Defined cases: null html is an empty page and null or unusable URLs share the host ``''``; unclosed and
stray tags are tolerated (a ``head`` ends where something begins that it cannot hold; an ``article`` opened
inside dropped elements counts if none of them but a ``form`` has an end tag, and leaves the other text in);
repeated pages are extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize

MIN_PAGES, MIN_IMPORTANCE, MIN_TEXT, DECAY = 8, 0.2, 40, 0.9
GROUP = 5_000  # hosts of more scored elements are not scored in one group, but depth by depth
SALTS = 16  # tasks that a path's pages are spread over when such a host's paths meet their pages

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var ruby rt rp wbr img".split()
)
DROPPED = frozenset(
    "nav header footer aside form button select option fieldset menu dialog head svg canvas object audio video math".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner cookie cookies consent notice nav navbar "
    "navigation menu sidebar breadcrumb breadcrumbs footer header masthead comment comments disqus respond reply "
    "share sharing social related newsletter subscribe popup modal widget pagination".split()
)

MAIN = frozenset(("article", "main"))
IN_HEAD = frozenset("base basefont bgsound link meta title noscript script style template".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|</([a-zA-Z][^\s/>]*)[^>]*>"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>)",
    re.S,
)
_NAME = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I | re.S)
_DIGITS = re.compile(r"\d+")
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


class _Element:
    """``up``: the element around it. ``drops``: declares itself no main text. ``under``: the nearest around it
    that does. ``lost``: such an element has an end tag, or one around it has. ``dropped``: goes by what is declared.
    ``children``: paths of the elements in it, declared ones only inside of declared ones."""

    __slots__ = ("tag", "path", "up", "drops", "under", "lost", "depth", "dropped", "inside", "children")

    def __init__(self, tag: str, path: int, up: _Element | None, drops: bool, inside: bool):
        self.tag, self.path, self.up, self.drops = tag, path, up, drops
        self.under = up if up and up.drops else up and up.under
        self.lost = False
        self.depth: int = up.depth + 1 if up else 0
        self.dropped = drops or bool(up and up.dropped and tag not in MAIN)
        self.inside = inside
        self.children: list[int] = []

    @property
    def apart(self) -> bool:
        """A declared element in one that is not."""
        return self.drops and self.under is None


def _signed(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


class Page:
    """One parsed page: ``elements`` (in page order) and ``blocks`` (text, element it stands in)."""

    def __init__(self, source: str):
        root = _Element("body", 0, None, False, False)
        self.elements = [root]
        self.blocks: list[tuple[str, _Element]] = []
        self._stack, self._text = [root], []
        self._drops: list[_Element] = []
        at = 0
        while m := _TAG.search(source, at):
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            if m[2]:
                tag = m[2].lower()
                if tag in RAW and not m[3].endswith("/>"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    at = end.end() if end else len(source)
                else:
                    self._open(tag, m[3])
            elif m[1]:
                self._close(m[1].lower())
        self._add(source[at:])
        self._flush()
        for e in self._drops:
            e.lost = e.lost or bool(e.under and e.under.lost)
        for e in self.elements[1:]:
            e.dropped = e.dropped or bool(e.under and e.under.lost)
            if not e.apart:
                e.up.children.append(e.path)

    def _end_head(self) -> None:
        """A head ends, closed or not, where something begins that it cannot hold."""
        if self._stack[-1].tag == "head":
            self._flush()
            self._stack.pop()

    def _add(self, text: str) -> None:
        if self._stack[-1].tag == "head" and not text.isspace():
            self._end_head()
        self._text.append(entities.unescape(text))

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text = []
        if text:
            self.blocks.append((text, self._stack[-1]))

    def _open(self, tag: str, rest: str) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag == "br" or tag in ("td", "th"):
            self._add(" ")
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        named = {k.lower(): v.strip("\"'") for k, v in _NAME.findall(rest)} if "=" in rest else {}
        words = re.split(r"[^a-z0-9]+", f"{named.get('class', '')} {named.get('id', '')}".lower()) if named else ()
        drops = tag in DROPPED or named.get("role", "").lower() in ROLES or any(w in NAMED for w in words)
        if tag in INLINE and not drops:
            return
        if tag in ("html", "body"):
            return
        self._flush()
        while len(self._stack) > 1 and (self._stack[-1].tag == "p" or self._stack[-1].tag in _CLOSES.get(tag, ())):
            self._stack.pop()
        up = self._stack[-1]
        if rest.endswith("/>") and tag not in ("p", "div", "article", "section"):
            return
        # the path tells which elements declare themselves
        key = f"{'!' * drops}{tag}.{' '.join(sorted(named.get('class', '').split()))}#{named.get('id', '')}"
        path = _signed(up.path.to_bytes(8, "big", signed=True) + _DIGITS.sub("0", key).encode("utf-8", "replace"))
        new = _Element(tag, path, up, drops, tag in MAIN or up.inside)
        if drops:
            self._drops.append(new)
        self.elements.append(new)
        self._stack.append(new)

    def _close(self, tag: str) -> None:
        for i in range(len(self._stack) - 1, 0, -1):
            if self._stack[i].tag == tag:
                self._flush()
                self._stack[i].lost = self._stack[i].drops and tag != "form"  # some sites' forms hold the whole page
                del self._stack[i:]
                return

    def text(self, removed: frozenset[int] = frozenset(), declared: bool = True) -> str:
        known: dict[_Element | None, bool] = {None: False}

        def gone(element: _Element) -> bool:
            """Whether the element or one around it is removed."""
            around, e = [], element
            while e not in known:
                around.append(e)
                e = e.up
            low = known[e]
            for e in reversed(around):
                low = known[e] = low or e.path in removed
            return low

        stay = [(text, e) for text, e in self.blocks if not (declared and e.dropped) and not gone(e)]
        only = declared and any(e.inside and not e.under for _, e in stay)
        return "\n\n".join(text for text, e in stay if e.inside or not only)


PRESENCE, STYLE, CONTENT = 0, 1, 2
_FEATURE = "host string, path long, parent long, depth int, apart int, kind int, feature long, n long, chars long"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in _FEATURE.split(", "))])
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source or "")
            parent = {e.path: (e.up.path if e.up else 0, e.depth, int(e.apart)) for e in page.elements}
            styles = Counter((e.path, _signed(repr(e.children).encode())) for e in page.elements)
            contents: Counter = Counter()
            inside: Counter = Counter()  # characters in an element, those of its children included
            long: Counter = Counter()  # sum of the hashes of the long texts in it
            for text, e in page.blocks:
                contents[e.path, _signed(text.encode("utf-8", "replace"))] += 1
                inside[e] += len(text)
                # declared elements do not tell pages apart
                long[e] += _signed(text.encode("utf-8", "replace")) if len(text) >= MIN_TEXT and not e.dropped else 0
            chars: Counter = Counter()
            other: Counter = Counter()  # the same sum over the texts outside of a path
            for e in reversed(page.elements):  # children come after their parents
                chars[e.path] += 0 if e.apart else inside[e]
                other[e.path] -= long[e]
                inside[e.up] += 0 if e.apart else inside[e]
                long[e.up] += long[e]
            for p in parent:
                other[p] = (other[p] + long[None] + (1 << 63)) % (1 << 64) - (1 << 63)
            rows += [(host, p, *parent[p], PRESENCE, other[p], 1, chars[p]) for p in parent]
            rows += [(host, p, *parent[p], STYLE, f, n, 0) for (p, f), n in styles.items()]
            rows += [(host, p, *parent[p], CONTENT, f, n, 0) for (p, f), n in contents.items()]
        columns = list(zip(*rows)) or [()] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _rate(r: dict, n: int, weight: float, weighted: float, best: float) -> tuple[float, float]:
    """Importance of an element, and of the most important text in its branch. Of its scored children: how many,
    their occurrences, the sum of these times importance, and their ``best``."""
    unit = math.log(r["pages"])
    own = min(1.0, max(0.0, 1 - r["spread"] / unit / r["texts"])) if r["texts"] else 0.0
    best = max(own, best, 1.0 if r["rare_chars"] else 0.0)
    looks = min(1.0, max(0.0, r["style"] / unit))
    if not (n or r["rare"] or r["texts"]):
        return looks, best
    # the children scored, those that prove nothing, the element's own texts
    own_weight = r["occurrences"] if r["texts"] else 0
    inner = (weighted + r["rare_occurrences"] + own_weight * own) / (weight + r["rare_occurrences"] + own_weight)
    fade = DECAY ** (n + r["rare"] + (r["texts"] > 0)) if n or r["rare"] else 0.0
    return fade * looks + (1 - fade) * inner, best


def _is_low(r: dict, importance: float, best: float) -> bool:
    # rounding must not undo MIN_PAGES pages that all differ
    return importance < MIN_IMPORTANCE and best < MIN_IMPORTANCE and r["others"] > math.log(MIN_PAGES) - 1e-9


def _low_branches(key: tuple, tree: pd.DataFrame) -> pd.DataFrame:
    """The paths of one host whose branches go. ``tree``: a row per element that :func:`scored` keeps."""
    rows = {int(r["path"]): r for r in tree.to_dict("records")}
    below = {p: [0, 0.0, 0.0, 0.0] for p in rows}
    low = []
    for p in sorted(rows, key=lambda p: -rows[p]["depth"]):
        if not p:
            continue
        r = rows[p]
        importance, best = _rate(r, *below[p])
        b = below[int(r["parent"])]
        b[0] += 1
        b[1] += r["occurrences"]
        b[2] += r["occurrences"] * importance
        b[3] = max(b[3], 0.0 if r["apart"] else best)
        if _is_low(r, importance, best):
            low.append(p)
    return pd.DataFrame([(key[0], low)] if low else [], columns=["host", "low"])


def _rate_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for r in frame.to_dict("records"):
            importance, best = _rate(r, r["n"], r["weight"], r["weighted"], r["best"])
            low = _is_low(r, importance, best)
            out.append((r["host"], r["path"], r["parent"], r["occurrences"], importance, 0.0 if r["apart"] else best, low))
        yield pd.DataFrame(out, columns=["host", "path", "parent", "occurrences", "importance", "best", "low"])


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """The merged tree: a row per (host, path) with parent, depth, apart (declared in one that is not), pages, others
    (entropy of the other texts of its pages), occurrences, texts, spread (summed entropy of its texts over pages, in nats), style (entropy of its presentations), chars
    (of all text in it)."""
    log = F.log(F.col("n").cast("double"))
    features = (
        pages.select(host(F.col("url")).alias("host"), "html")
        .mapInArrow(_features, _FEATURE)
        .groupBy("host", "path", "kind", "feature")
        .agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.min("apart").alias("apart"),
            F.sum("n").alias("c"),
            F.sum(F.col("n") * log).alias("s"),
            F.sum("chars").alias("chars"),
        )
    )
    c = F.col("c").cast("double")
    presence, style, content = (F.col("kind") == k for k in (PRESENCE, STYLE, CONTENT))
    return (
        features.groupBy("host", "path")
        .agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.min("apart").alias("apart"),
            F.sum(F.when(presence, F.col("c")).otherwise(0)).alias("pages"),
            F.sum(F.when(presence, c * F.log(c)).otherwise(0.0)).alias("other_sum"),
            F.sum(F.when(style, F.col("c")).otherwise(0)).alias("occurrences"),
            F.sum(F.when(style, c * F.log(c)).otherwise(0.0)).alias("style_sum"),
            F.sum(F.when(content, 1).otherwise(0)).alias("texts"),
            F.sum(F.when(content, F.log(c) - F.col("s") / c).otherwise(0.0)).alias("spread"),
            F.sum("chars").alias("chars"),
        )
        .withColumn(
            "style",
            F.coalesce(F.log("occurrences") - F.try_divide(F.col("style_sum"), F.col("occurrences")), F.lit(0.0)),
        )
        .withColumn("others", F.log("pages") - F.col("other_sum") / F.col("pages"))
        .drop("style_sum", "other_sum")
    )


def scored(tree: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """The rows of ``tree`` on enough pages to be scored (and each host's root), with the number of their
    children that are not, ``rare``, and those children's ``rare_occurrences`` and ``rare_chars``. ``pages`` is
    not read: what is enough does not depend on the host's size."""
    is_scored = (F.col("path") == 0) | (F.col("pages") >= MIN_PAGES)
    own = [c for c in tree.columns if c not in ("host", "path")]
    return (
        tree.withColumn("scored", is_scored)
        .groupBy("host", F.when(F.col("scored"), F.col("path")).otherwise(F.col("parent")).alias("path"))
        .agg(
            *[F.max(F.when(F.col("scored"), F.col(c))).alias(c) for c in own],
            F.count_if(~F.col("scored")).alias("rare"),
            F.sum(F.when(F.col("scored"), 0).otherwise(F.col("occurrences"))).alias("rare_occurrences"),
            F.sum(F.when(F.col("scored"), 0).otherwise(F.col("chars"))).alias("rare_chars"),
        )
        .where(F.col("pages").isNotNull())
    )


def low_branches(tree: DataFrame) -> DataFrame:
    """(host, low): the paths to remove, a row per host that has any. ``tree``: rows of :func:`scored`."""
    return tree.groupBy("host").applyInPandas(_low_branches, "host string, low array<long>")


def low_by_depth(tree: DataFrame) -> DataFrame | None:
    """(host, path) of the branches to remove, as :func:`low_branches` finds them but with no host in one task."""
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    zero = {"n": F.lit(0).cast("long"), "weight": F.lit(0.0), "weighted": F.lit(0.0), "best": F.lit(0.0)}
    below, low = None, None
    for depth in range(deepest, 0, -1):
        level = tree.where(F.col("depth") == depth)
        if below is None:
            level = level.withColumns(zero)
        else:
            level = level.join(below, ["host", "path"], "left")
            level = level.withColumns({c: F.coalesce(c, z) for c, z in zero.items()})
        rated = materialize(
            level.mapInPandas(
                _rate_rows,
                "host string, path long, parent long, occurrences long, importance double, best double, low boolean",
            )
        )
        below = rated.groupBy("host", F.col("parent").alias("path")).agg(
            F.count("*").alias("n"),
            F.sum("occurrences").cast("double").alias("weight"),
            F.sum(F.col("occurrences") * F.col("importance")).alias("weighted"),
            F.max("best").alias("best"),
        )
        gone = rated.where("low").select("host", "path")
        low = gone if low is None else low.unionByName(gone)
    return low


def _paths(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for source in columns:
        yield pa.array([list({e.path for e in Page(h or "").elements}) for h in source.to_pylist()], pa.list_(pa.int64()))


def low_of_pages(pages: DataFrame, low: DataFrame) -> DataFrame:
    """(low_host, low_key, low): the paths to remove that a page shows, by its host and :func:`page_key`."""
    paths = F.arrow_udf(_paths, T.ArrayType(T.LongType()))
    shown = (
        pages.select(host(F.col("url")).alias("host"), page_key().alias("low_key"), F.explode(paths("html")).alias("path"))
        .withColumn("salt", F.pmod(F.xxhash64("low_key"), F.lit(SALTS)).cast("int"))
    )
    salted = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        shown.join(salted, ["host", "path", "salt"])
        .groupBy(F.col("host").alias("low_host"), "low_key")
        .agg(F.collect_set("path").alias("low"))
    )


def page_key() -> Column:
    return F.sha2(F.coalesce("html", F.lit("")), 256)


def _texts(declared: bool):
    def run(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for source, low in columns:
            pairs = zip(source.to_pylist(), low.to_pylist())
            yield pa.array([Page(h or "").text(frozenset(x or ()), declared) for h, x in pairs], pa.string())

    run.__annotations__ = {"columns": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, T.StringType())


def extract(pages: DataFrame, declared: bool = True) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, url, text: blocks joined by an empty line. ``declared``: elements
    also go by what they declare to be; without it the style tree decides alone."""
    text = _texts(declared)
    out = ("page_id", "url", text("html", "low").alias("text"))
    page_host = host(F.col("url"))
    tree = materialize(scored(style_tree(pages)))
    large = tree.groupBy(F.col("host").alias("large")).agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("large")
    by_depth = None if large.isEmpty() else low_by_depth(tree.join(large, F.col("host") == F.col("large"), "left_semi"))
    if by_depth is None:
        low = materialize(low_branches(tree)).withColumnRenamed("host", "low_host")
        return pages.join(low, page_host == F.col("low_host"), "left").select(*out)
    large = materialize(large)
    small = tree.join(large, F.col("host") == F.col("large"), "left_anti")
    low = materialize(low_branches(small)).withColumnRenamed("host", "low_host")
    rest = pages.join(large, page_host == F.col("large"), "left_anti")
    hot = pages.join(large, page_host == F.col("large"), "left_semi")
    hot_low = materialize(low_of_pages(hot, by_depth))
    same = (page_host == F.col("low_host")) & (page_key() == F.col("low_key"))
    return (
        rest.join(low, page_host == F.col("low_host"), "left")
        .select(*out)
        .unionByName(hot.join(hot_low, same, "left").select(*out))
    )
