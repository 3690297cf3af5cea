"""Main text of web pages by a host suffix array.

Pages are cut into blocks, and their token streams (block markers and words, told apart by
host and element path) are concatenated. A suffix array over the stream gives its distinct
runs of ``min_run`` tokens and the pages that have them; of these every page keeps the
fingerprints that are least in some window of ``window`` runs (winnowing), so that a passage of
``min_run + window - 1`` tokens on two pages leaves the same fingerprint on both. The fingerprints
of a host meet, and one that two distinct pages have is shared.

What is shared decides per host and element path. The main element is the deepest
container that holds at least ``MASS`` of the host's unshared runs. What lies outside of
it is boilerplate; in it a path is kept with all its passages, copied ones too, unless nearly all
of it is shared and far more so than the main path; then its blocks that shared runs cover go. Elements
that are menus, headers, footers, forms and the like by their tag or role are never part of a
main element around them. Where the runs find no main element below the body (one distinct page on
the host, or too little text), the tags decide as far as they go, and of the rest the blocks
of shared paths go where runs cover them.

No page is shuffled: fingerprints go to the hosts, and a host's verdict (its main element,
its shared paths and their shared runs) comes back to its pages, broadcast only within the session's
measured limit.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.textops import mix, runs, words
from quarry.operators.joins import join_small
from quarry.session import ensure_checkpoint_dir

NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*")
STOP = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "textarea", "title", "template", "noscript", "svg", "iframe", "select")}

INLINE = frozenset("a abbr b bdi bdo big br cite code data dfn em font i img ins del kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button head".split())
BOILERPLATE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside notice notices cookie cookies "
    "consent banner ad ads advert adverts advertisement advertising sponsored sponsor promo promotion newsletter subscribe "
    "comment comments disqus respond share sharing social related recommended popup modal login search form".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Main elements of a page without one: no container below these is found.
WHOLE = ("", "html", "body", "html/body")
MASS = 0.8
DEPTH = 32  # paths are told apart by their outermost elements

# Of a block: BOILERPLATE is so by the names of a class or id outside of a main element, INNER by those below one,
# DOUBTFUL is a main element's that is so named itself or lies in what is; FIXED is boilerplate by its tag or role.
OTHER, MAIN, BOILERPLATE, FIXED, DOUBTFUL, INNER = range(6)


def _kind(name: str, attributes: str) -> int:
    """What an element says of its content."""
    if name in BOILERPLATE_TAGS:
        return FIXED
    named = False
    main = name in ("article", "main")
    if attributes:
        for m in ATTRIBUTE.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                if value in BOILERPLATE_ROLES:
                    return FIXED
                main = main or value in ("main", "article")
            elif name not in HEADINGS and name not in ("body", "html", "main"):
                named = named or any(part in BOILERPLATE_NAMES for part in re.split("[^a-z0-9]+", value))
    return (DOUBTFUL if main else BOILERPLATE) if named else MAIN if main else OTHER


def _inner(outer: int, kind: int) -> int:
    """Kind of a block in an element of ``kind`` whose surroundings make a block ``outer``."""
    if FIXED in (outer, kind):
        return FIXED
    if outer in (MAIN, DOUBTFUL, INNER):  # within a main element
        return INNER if outer == INNER or kind in (BOILERPLATE, DOUBTFUL) else outer
    if kind in (MAIN, DOUBTFUL):
        return DOUBTFUL if DOUBTFUL == kind or outer == BOILERPLATE else MAIN
    return BOILERPLATE if BOILERPLATE in (outer, kind) else OTHER


def _label(name: str, attributes: str) -> str:
    """An element in a path: its name and its first class or id without digits."""
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() != "role":
            value = re.sub("[^A-Za-z_-]", "", ((m[2] or m[3] or m[4] or "").split() or [""])[0])[:24]
            if value:
                return f"{name}.{value}"
    return name


class _Tags:
    """Finds a page's tags from left to right; every character is looked at a bounded number of times."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}

    def end(self, at: int) -> int:
        """Place after the tag whose attributes begin at ``at``, or -1. A quote that nothing closes is no quote."""
        if self.last[">"] < at:
            return -1
        while True:
            m = STOP.search(self.page, at)
            if m is None:
                return -1
            if m[0] == ">":
                return m.end()
            if self.last[m[0]] > m.start():
                at = self.page.index(m[0], m.end()) + 1
                if self.last[">"] < at:
                    return -1
            else:
                at = m.end()

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, place after, lower-case name or empty, closes an element, attributes) of the next tag or comment."""
        page = self.page
        while True:
            at = page.find("<", at)
            if at < 0 or at + 1 >= len(page):
                return None
            if page.startswith("<!--", at):
                stop = page.find("-->", at + 4)
                return at, (stop + 3 if stop >= 0 else len(page)), "", False, ""
            if page[at + 1] in "!?":
                if self.last[">"] > at:
                    return at, page.index(">", at) + 1, "", False, ""
            else:
                closes = page[at + 1] == "/"
                name = NAME.match(page, at + 1 + closes)
                if name:
                    stop = self.end(name.end())
                    if stop >= 0:
                        return at, stop, name[0].lower(), closes, page[name.end():stop - 1]
                    if self.last[">"] < at:
                        return None
            at += 1


def blocks(page: str | None) -> list[tuple[int, str, str, int]]:
    """(kind, element path, text, depth of its innermost element that is boilerplate by tag or role) of each block
    with text, in page order.

    Character references are decoded, white space is one space, ends are trimmed.
    """
    page = page or ""
    tags = _Tags(page)
    out: list[tuple[int, str, str, int]] = []
    # Of an open element: name, kind of a block in it, path, depth, depth of the innermost fixed one, place of the
    # innermost element that is not inline.
    stack: list[tuple[str, int, str, int, int, int]] = [("", OTHER, "", 0, 0, 0)]
    open_names: dict[str, int] = {}
    text: list[str] = []

    def end_block() -> None:
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            text.clear()
            if joined:
                _, kind, path, _, fixed, _ = stack[-1]
                out.append((kind, path, joined, fixed))

    def cut(size: int) -> None:
        while len(stack) > size:
            open_names[stack.pop()[0]] -= 1

    at = 0
    while True:
        tag = tags.next(at)
        if tag is None:
            text.append(page[at:])
            break
        start, stop, name, closes, attributes = tag
        if start > at:
            text.append(page[at:start])
        at = stop
        if not name:
            continue
        if name == "br":
            text.append(" ")
            continue
        if name not in INLINE:
            end_block()
        if closes:
            if open_names.get(name):
                while stack[-1][0] != name:
                    cut(len(stack) - 1)
                cut(len(stack) - 1)
            continue
        if name in RAW:
            end = RAW[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name not in INLINE:  # an open paragraph ends where another block begins
            place = stack[-1][5]
            if stack[place][0] == "p":
                cut(place)
            if name == "li" and stack[-1][0] == "li":
                cut(len(stack) - 1)
        _, outer, path, depth, fixed, place = stack[-1]
        own = _kind(name, attributes)
        if name not in INLINE:
            depth, place = depth + 1, len(stack)
            if depth <= DEPTH:
                path = f"{path}/{_label(name, attributes)}" if path else _label(name, attributes)
        stack.append((name, _inner(outer, own), path, depth, depth if own == FIXED else fixed, place))
        open_names[name] = open_names.get(name, 0) + 1
    end_block()
    return out


def repeated(tokens: np.ndarray, page_of: np.ndarray, min_run: int) -> np.ndarray:
    """Which tokens lie in a run of ``min_run`` or more that two distinct pages share.

    The suffix array is built by prefix doubling as deep as ``min_run`` tokens; a
    longer shared run is covered by its overlapping parts.
    """
    suffixes, first = run_groups(tokens, page_of, min_run)
    if not len(suffixes):
        return np.zeros(len(tokens), bool)
    low = np.minimum.reduceat(page_of[suffixes], first)
    high = np.maximum.reduceat(page_of[suffixes], first)
    shared = np.repeat(low < high, np.diff(np.r_[first, len(suffixes)]))
    return _cover(len(tokens), suffixes[shared], min_run)


def run_groups(tokens: np.ndarray, page_of: np.ndarray, min_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes with ``min_run`` tokens of their own page, sorted by these; where each group of equal runs begins)."""
    n = len(tokens)
    if n < min_run:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    depth = 1
    while depth < min_run:
        step = min(depth, min_run - depth)
        after = np.full(n, -1, np.int64)
        after[:n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + after + 1, return_inverse=True)[1].astype(np.int64)
        depth += step
    inner = np.zeros(n, bool)  # the suffix has min_run tokens of its own page
    inner[:n - min_run + 1] = page_of[:n - min_run + 1] == page_of[min_run - 1:]
    suffixes = np.argsort(rank, kind="stable")
    suffixes = suffixes[inner[suffixes]]
    if not len(suffixes):
        return suffixes, np.zeros(0, np.int64)
    return suffixes, np.flatnonzero(np.r_[True, rank[suffixes][1:] != rank[suffixes][:-1]])


def _cover(n: int, begins: np.ndarray, min_run: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a run of ``min_run`` from one of ``begins``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + min_run, -1)
    return np.cumsum(edge)[:-1] > 0


# What is kept of a page: the first of these that keeps any block, as (kinds kept in any case, kinds kept unless shared).
STEPS = (
    (frozenset({MAIN}), frozenset({DOUBTFUL})),
    (frozenset(), frozenset({OTHER, INNER})),
    (frozenset(), frozenset({BOILERPLATE})),
    (frozenset({DOUBTFUL, INNER}), frozenset()),
)


class Stream:
    """Blocks and token stream of some pages; a block is its marker, then its words. Tokens differ by host and path."""

    def __init__(self, pages: list[str | None], salts: np.ndarray | None = None) -> None:
        self.cut = [blocks(p) for p in pages]
        texts = [b[2].encode("utf-8", "replace") for page in self.cut for b in page]
        hashes, before = words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
        n_blocks = [len(c) for c in self.cut]
        path = np.array([_mark(b[1]) for page in self.cut for b in page], np.uint64)
        if salts is not None:
            path = mix(path ^ np.repeat(salts, n_blocks))
        self.sizes = np.diff(before)
        self.paths = path  # of each block
        self.block = np.repeat(np.arange(len(path)), self.sizes + 1)  # of each token
        tokens = np.insert(hashes, before[:-1], np.uint64(1)) if len(path) else hashes
        self.tokens = mix(tokens ^ path[self.block]) if len(path) else tokens
        self.row = np.repeat(np.arange(len(pages)), n_blocks)[self.block] if len(path) else np.zeros(0, np.int64)
        self.own = np.ones(len(self.tokens), bool)
        self.own[before[:-1] + np.arange(len(path))] = False

    def inner(self, min_run: int) -> np.ndarray:
        """Where a run of ``min_run`` tokens of one page begins."""
        n = len(self.tokens) - min_run + 1
        return np.flatnonzero(self.row[:n] == self.row[min_run - 1:]) if n > 0 else np.zeros(0, np.int64)

    def covered(self, shared: np.ndarray, min_run: int) -> np.ndarray:
        """Words of each block that lie in a run whose hash is in ``shared``."""
        begins = self.inner(min_run)
        if not len(begins) or not len(shared):
            return np.zeros(len(self.sizes), np.int64)
        begins = begins[np.isin(runs(self.tokens, min_run)[begins], shared)]
        hit = _cover(len(self.tokens), begins, min_run) & self.own
        return np.bincount(self.block[hit], minlength=len(self.sizes))


def winnowed(values: np.ndarray, group: np.ndarray, window: int) -> np.ndarray:
    """Which ``values`` are least in some ``window`` consecutive ones of their group (all of a shorter group)."""
    n = len(values)
    reach = np.ones(n, np.int64)
    room = np.ones(n, np.int64)
    for sign in (1, -1):
        v, g = values[::sign], group[::sign]
        alive, inside = np.ones(n, bool), np.ones(n, bool)
        more, space = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for d in range(1, window):
            inside[:d] = False
            inside[d:] &= g[d:] == g[:-d]
            alive &= inside
            # Of equal ones the first is taken.
            alive[d:] &= (v[:-d] > v[d:]) if sign == 1 else (v[:-d] >= v[d:])
            more += alive
            space += inside
        reach += more[::sign]
        room += space[::sign]
    return reach >= np.minimum(window, room)


@lru_cache(maxsize=1 << 14)
def _mark(path: str) -> int:
    return int.from_bytes(blake2b(path.encode("utf-8", "replace"), digest_size=8).digest(), "little")


SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.LongType()),
    T.StructField("by_runs", T.BooleanType())])


def _chunks(batch: pa.RecordBatch, chunk_pages: int, chunk_bytes: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Parts of a batch whose first column is html, with their pages; one page may be longer than ``chunk_bytes``."""
    at = 0
    while at < batch.num_rows:
        held, size = [], 0
        for k in range(at, min(batch.num_rows, at + chunk_pages)):
            page = batch.column(0)[k].as_py()
            if held and size + len(page or "") > chunk_bytes:
                break
            held.append(page)
            size += len(page or "")
        yield batch.slice(at, len(held)), held
        at += len(held)


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def fingerprints(stream: Stream, pages: np.ndarray, min_run: int, window: int) -> tuple[np.ndarray, ...]:
    """Of each distinct run that some page keeps: (a block that it begins in, hash, number kept, least and greatest page)."""
    begins = stream.inner(min_run)
    suffixes, first = run_groups(stream.tokens, stream.row, min_run)
    if not len(suffixes):
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none.view(np.uint64), none.view(np.uint64)
    values = runs(stream.tokens, min_run)
    kept = np.zeros(len(stream.tokens), bool)
    kept[begins[winnowed(values[begins], stream.row[begins], window)]] = True
    path = stream.paths[stream.block]
    kept[begins] &= path[begins] == path[begins + min_run - 1]  # a run says nothing of a path that it leaves
    page = pages[stream.row[suffixes]]
    n = np.add.reduceat(kept[suffixes].astype(np.int64), first)
    low, high = np.minimum.reduceat(page, first), np.maximum.reduceat(page, first)
    some = n > 0
    return stream.block[suffixes[first]][some], values[suffixes[first]][some], n[some], low[some], high[some]


_DEALT = "salt long, part int, name string, keys binary, counts binary, pages binary"


def _dealt(table: DataFrame, parts: dict[int, int], min_run: int, window: int, chunk_pages: int, chunk_bytes: int) -> DataFrame:
    """A chunk's fingerprints by host, part of a large host, and path: hashes, numbers, least and greatest page (32 bits).

    The path '' has no fingerprints but all pages.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pages in _chunks(batch, chunk_pages, chunk_bytes):
                salts, page = _longs(part.column(1)), _longs(part.column(2)).view(np.uint64) >> np.uint64(32)
                stream = Stream(pages, salts.view(np.uint64))
                block, keys, n, low, high = fingerprints(stream, page, min_run, window)
                names = [b[1] for p in stream.cut for b in p]
                own_salt = np.repeat(salts, [len(c) for c in stream.cut])
                rows: list[tuple] = []
                for s in np.unique(salts).tolist():
                    own = np.unique(page[salts == s])
                    rows.append((s, 0, "", b"", b"", np.r_[own, own].astype("<u4").tobytes()))
                split = np.array([parts.get(s, 1) for s in own_salt.tolist()], np.uint64)
                place = (keys % split[block]).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
                order = np.lexsort((place, stream.paths[block]))
                if len(order):
                    path, where = stream.paths[block][order], place[order]
                    cuts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (where[1:] != where[:-1]), True])
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        o = order[a:b]
                        rows.append((int(own_salt[block[o[0]]]), int(where[a]), names[block[o[0]]], keys[o].astype("<u8").tobytes(),
                                     np.minimum(n[o], 65535).astype("<u2").tobytes(), np.r_[low[o], high[o]].astype("<u4").tobytes()))
                if rows:
                    c = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.string()),
                         *(pa.array(x, pa.binary()) for x in c[3:])], names=["salt", "part", "name", "keys", "counts", "pages"])

    return table.select("html", "salt", "page").mapInArrow(run, _DEALT)


def shared_runs(names: list[str], keys: list[bytes], counts: list[bytes], pages: list[bytes]) -> Iterator[tuple[str, int, int, np.ndarray]]:
    """(path, fingerprints, shared ones, hashes of these) from the rows of one host, or of a part of it.

    The path '' gives the number of distinct pages twice over.
    """
    by_name: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        by_name.setdefault(name, []).append(k)
    for name, rows in by_name.items():
        ends = [np.frombuffer(pages[k], "<u4").reshape(2, -1) for k in rows]
        low, high = np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends])
        if not name:
            n = len(np.unique(low))
            yield name, n, n, np.zeros(0, np.uint64)
            continue
        key = np.concatenate([np.frombuffer(keys[k], "<u8") for k in rows])
        n = np.concatenate([np.frombuffer(counts[k], "<u2") for k in rows]).astype(np.int64)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        many = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
        yield name, int(n.sum()), int(np.add.reduceat(n[order], first)[many].sum()), key[order][first][many]


def _paths(dealt: DataFrame) -> DataFrame:
    """``salt, name, total, shared, keys`` from :func:`_dealt`: fingerprints of each path of a host (or of a part of it)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, ([], [], [], [])

        def out() -> pa.RecordBatch:
            got = [(last[0], name, n, m, key.tobytes()) for name, n, m, key in shared_runs(*held)]
            c = list(zip(*got, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), pa.array(c[2], pa.int64()),
                                               pa.array(c[3], pa.int64()), pa.array(c[4], pa.binary())],
                                              names=["salt", "name", "total", "shared", "keys"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != last:
                    if held[0]:
                        yield out()
                    last, held = row[:2], ([], [], [], [])
                for column, value in zip(held, row[2:], strict=True):
                    column.append(value)
        if held[0]:
            yield out()

    return dealt.repartition("salt", "part").sortWithinPartitions("salt", "part").mapInArrow(
        run, "salt long, name string, total long, shared long, keys binary")


def verdicts(paths: DataFrame) -> DataFrame:
    """``salt, main, loose, runs``: of each host its main element (null: none found), the paths whose blocks go where
    shared runs cover them, and these runs."""
    sums = paths.groupBy("salt", "name").agg(F.sum("total").alias("total"), F.sum("shared").alias("shared"))
    hosts = sums.where("name = ''").select("salt", F.col("total").alias("pages"))
    own = sums.where("name <> ''").withColumn("single", F.col("total") - F.col("shared"))
    whole = own.groupBy("salt").agg(F.sum("single").alias("whole"))
    parts = F.split("name", "/")
    depth = F.size(parts) - 1
    outer = own.select("salt", "single", F.explode(F.transform(F.sequence(F.lit(0), depth), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("box")))).alias("x")).select("salt", "single", "x.*")
    boxes = outer.groupBy("salt", "box", "depth").agg(F.sum("single").alias("single")).join(whole, "salt").where(
        (F.col("single") >= MASS * F.col("whole")) & (F.col("whole") > 0))
    main = boxes.groupBy("salt").agg(F.max_by("box", "depth").alias("main"))
    main = hosts.join(main, "salt", "left").select("salt", F.when((F.col("pages") > 1) & ~F.col("main").isin(*WHOLE), F.col("main")).alias("main"))
    # Inside a main element a path must be shared nearly throughout, and far more than the main path, to lose blocks.
    own = own.join(main, "salt").withColumn("share", F.col("shared") / F.col("total"))
    base = own.where("main is not null and startswith(name, concat(main, '/'))").groupBy("salt").agg(F.max_by("share", "single").alias("base"))
    inside = F.col("main").isNotNull() & (F.col("total") >= 32) & (F.col("share") >= F.greatest(F.lit(0.9), F.col("base") + 0.3)) & (
        (F.col("name") == F.col("main")) | F.startswith("name", F.concat("main", F.lit("/"))))
    loose = own.join(base, "salt", "left").where(inside | (F.col("main").isNull() & (F.col("share") >= 0.3)))
    loose = loose.select("salt", "name").join(paths.select("salt", "name", "keys"), ["salt", "name"]).groupBy("salt").agg(
        F.collect_set("name").alias("loose"), F.collect_list("keys").alias("runs"))
    return main.join(loose, "salt", "left").select("salt", "main", "loose", "runs")


def main_text(page: list[tuple[int, str, str, int]], covered: list[bool], main: str | None) -> tuple[str, bool]:
    """(main text, the host's main element is on the page) of a page's blocks; ``covered`` ones are boilerplate by runs."""
    if main is not None:
        inside = main + "/"
        depth = main.count("/") + 1
        own = [k for k, b in enumerate(page) if b[1].startswith(inside) or b[1] == main]
        if own:
            return "\n".join(page[k][2] for k in own if not covered[k] and page[k][3] <= depth), True
    for always, unshared in STEPS:
        kept = [b[2] for b, c in zip(page, covered, strict=True) if b[0] in always or (b[0] in unshared and not c)]
        if kept:
            return "\n".join(kept), False
    return "", False


def extract_main_text(pages: DataFrame, min_run: int = 8, window: int = 8, share: float = 0.8, chunk_pages: int = 256,
                      chunk_bytes: int = 1 << 21, host_pages: int = 4096) -> DataFrame:
    """Main text of each row of ``pages(page_id, url, html)`` (``SCHEMA``); ``by_runs`` where the host's runs found the main element.

    A null or empty page gives an empty text. Pages without a url, or whose url has
    no host, count as one host. Repeated rows each give a row; identical pages
    do not make each other boilerplate. Other columns are ignored; an empty table gives no rows. The chunk
    bounds, and the pages after which a host's fingerprints are dealt into parts, are bounds of memory and do not change
    the result.
    """
    ensure_checkpoint_dir(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    page = F.col("html").cast("string")
    table = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                         page.alias("html"), F.xxhash64(host).alias("salt"), F.xxhash64(host, page).alias("page"))
    # At most the number of pages over ``host_pages`` of them.
    large = table.groupBy("salt").agg(F.count("*").alias("n")).where(F.col("n") > host_pages).collect()
    parts = {r["salt"]: -(-r["n"] // host_pages) for r in large}
    dealt = _dealt(table.where("length(html) > 0"), parts, min_run, window, chunk_pages, chunk_bytes)
    found = verdicts(_paths(dealt).checkpoint()).checkpoint()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in _chunks(batch, chunk_pages, chunk_bytes):
                stream = Stream(held, _longs(part.column(1)).view(np.uint64))
                main, loose = part.column(2).to_pylist(), part.column(3).to_pylist()
                known = {bytes(k) for own in part.column(4).to_pylist() for k in own or []}
                shared = np.unique(np.frombuffer(b"".join(known), "<u8")) if known else np.zeros(0, np.uint64)
                words_in = stream.covered(shared, min_run)
                at, got = 0, []
                for own, box, names in zip(stream.cut, main, loose, strict=True):
                    names = set(names or [])
                    covered = [b[1] in names and words_in[at + k] >= share * max(1, stream.sizes[at + k]) for k, b in enumerate(own)]
                    got.append((*main_text(own, covered, box), len(own)))
                    at += len(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(5), part.column(6), pa.array([g[0] for g in got], pa.string()),
                     pa.array([len(g[0]) for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
                     pa.array([g[1] for g in got], pa.bool_())], names=SCHEMA.names)

    joined = join_small(table, found, ["salt"], "left", null_safe=False)
    return joined.select("html", "salt", "main", "loose", "runs", "page_id", "url").mapInArrow(run, SCHEMA)
