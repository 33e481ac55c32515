"""Deeply nested JSON text to related flat tables, by vectorised structural indexing.

A batch of payloads is one byte buffer.  NumPy builds bitmaps of unescaped quotes,
string interiors and structural characters; nesting depth is a prefix sum over the
brackets.  From the structural characters alone come a grammar check (a payload
that is not one complete JSON text gives nothing), the token stream with each
token's parent container, and the spans of keys and values.  No parser walks the
text; JSON kept inside a string is unescaped and indexed again in the next pass.

Element rules: a list's members are its elements and null members keep their place
without giving a row; an object whose members are all objects (or null) is keyed by
id and its members are the elements; any other single object is element 0; JSON
inside a string counts as what it encodes.  Other scalars give no element.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import spread

#: Bytes of payloads that are indexed together; a larger payload is one by itself.
CHUNK_BYTES = 1 << 20
ELEMENT_SCHEMA = "doc bigint, child string, parent_pos int, pos int, element_id string, parent_id string, body string"

_Q, _BS, _LB, _RB, _LC, _RC, _COMMA, _COLON = (ord(c) for c in '"\\[]{},:')
_BRACKETS = np.zeros(256, np.int8)
_BRACKETS[[_LB, _LC]] = 1
_BRACKETS[[_RB, _RC]] = -1
_STRUCT = np.zeros(256, bool)
_STRUCT[[_LB, _RB, _LC, _RC, _COMMA, _COLON]] = True
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 13, 32]] = True
_SCALAR = re.compile(rb"(?:-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity)\Z")
_BAD_ESCAPE = re.compile(rb'\\(?:[^"\\/bfnrtu]|u(?![0-9a-fA-F]{4}))')

# token kinds
_OPEN_A, _OPEN_O, _CLOSE_A, _CLOSE_O, _SEP, _PAIR, _STR, _ATOM = range(8)


class Index:
    """Structural index of several texts: per token kind, byte span, document, depth, parent, partner."""

    def __init__(self, texts: list[bytes]):
        # each text is followed by a zero byte, so that no token spans two texts
        self.buf = b"\0".join([*texts, b""])
        raw = np.frombuffer(self.buf, np.uint8)
        lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(lens)])[:-1] if len(texts) else np.zeros(0, np.int64)
        self.n_docs = len(texts)
        self.bad = np.zeros(self.n_docs, bool)
        if not len(raw):
            self._empty()
            return
        doc_of = np.repeat(np.arange(self.n_docs, dtype=np.int32), lens)
        # 1. quotes that no odd run of backslashes escapes
        bs = raw == _BS
        quote = raw == _Q
        if bs.any():
            at = np.arange(len(raw), dtype=np.int64)
            last_other = np.maximum.accumulate(np.where(bs, -1, at))
            run = at - last_other  # backslashes up to and with this byte
            odd = np.zeros(len(raw), bool)
            odd[1:] = bs[:-1] & (run[:-1] % 2 == 1)
            quote &= ~odd
        # 2. string interiors: parity of the quotes so far, restarted in each text
        n_quotes = np.cumsum(quote, dtype=np.int64)
        before = np.concatenate([[0], n_quotes])[self.starts]
        parity = (n_quotes - np.repeat(before, lens)) & 1
        inside = parity.astype(bool) & ~quote
        ends = self.starts + lens - 1
        self.bad |= parity[ends].astype(bool)
        # control characters are not allowed inside strings
        ctrl = inside & (raw < 32)
        ctrl[ends] = False
        self.bad[np.unique(doc_of[ctrl])] = True
        # 3. structural characters, quotes, and runs of anything else outside strings
        outside = ~inside & ~quote
        struct = _STRUCT[raw] & outside
        atom = outside & ~struct & ~_WHITE[raw]
        atom[ends] = False
        first = atom.copy()
        first[1:] &= ~atom[:-1]
        open_quote = quote & parity.astype(bool)
        tok = np.flatnonzero(struct | first | open_quote)
        c = raw[tok]
        kind = np.full(len(tok), _ATOM, np.int8)
        for ch, k in ((_LB, _OPEN_A), (_LC, _OPEN_O), (_RB, _CLOSE_A), (_RC, _CLOSE_O), (_COMMA, _SEP), (_COLON, _PAIR)):
            kind[struct[tok] & (c == ch)] = k
        kind[open_quote[tok]] = _STR
        end = tok + 1
        close_quotes = np.flatnonzero(quote & ~parity.astype(bool))
        opens = tok[kind == _STR]
        if len(opens):
            j = np.searchsorted(close_quotes, opens)
            end[kind == _STR] = np.where(j < len(close_quotes), close_quotes[np.minimum(j, len(close_quotes) - 1)] + 1 if len(close_quotes) else opens + 1, opens + 1)
        last = atom.copy()
        last[:-1] &= ~atom[1:]
        end[kind == _ATOM] = np.flatnonzero(last) + 1
        self.kind, self.start, self.end, self.doc = kind, tok, end, doc_of[tok]
        self._nest()
        self._check(bs & inside)
        self.start, self.end = self.start.tolist(), self.end.tolist()

    def _empty(self) -> None:
        self.kind = self.start = self.end = self.doc = self.depth = self.parent = self.partner = np.zeros(0, np.int64)

    def _nest(self) -> None:
        """Depth by prefix sum; parent and partner by ordering tokens on (document, depth)."""
        kind, doc = self.kind, self.doc
        n = len(kind)
        self.parent = np.full(n, -1, np.int64)
        self.partner = np.full(n, -1, np.int64)
        if not n:
            self.depth = np.zeros(0, np.int64)
            return
        is_open, is_close = kind <= _OPEN_O, (kind == _CLOSE_A) | (kind == _CLOSE_O)
        total = np.cumsum(is_open.astype(np.int64) - is_close)
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        counts = np.diff(np.concatenate([first, [n]]))
        base = np.repeat(np.concatenate([[0], total])[first], counts)
        after = total - base
        low = np.minimum.reduceat(after, first)
        self.bad[doc[first[low < 0]]] = True
        self.bad[doc[first[after[first + counts - 1] != 0]]] = True
        # a bracket has the depth of its own level, a member one more than its container
        self.depth = np.where(is_open, after - 1, after)
        # partner: brackets of one level alternate open, close
        b = np.flatnonzero(is_open | is_close)
        if len(b):
            o = b[np.lexsort((b, self.depth[b], doc[b]))]
            nx = np.concatenate([o[1:], [-1]])
            ok = is_open[o] & (nx >= 0) & is_close[nx] & (doc[o] == doc[nx]) & (self.depth[o] == self.depth[nx])
            self.partner[o[ok]], self.partner[nx[ok]] = nx[ok], o[ok]
            wrong = ok & ((kind[o] == _OPEN_A) != (kind[nx] == _CLOSE_A))
            self.bad[doc[o[wrong]]] = True
        # parent: the last open bracket one level up
        op = np.flatnonzero(is_open)
        if len(op):
            span = int(self.depth.max()) + 3
            level = doc.astype(np.int64) * span + self.depth + 1
            key_o = level[op] * (n + 1) + op
            order = np.argsort(key_o)
            key_o = key_o[order]
            want = (level - 1) * (n + 1) + np.arange(n)
            j = np.searchsorted(key_o, want) - 1
            cand = op[order[np.maximum(j, 0)]]
            hit = (j >= 0) & (level[cand] == level - 1) & (self.depth > 0)
            self.parent[hit] = cand[hit]

    def _check(self, escapes: np.ndarray) -> None:
        """The grammar, as allowed neighbours within each document."""
        kind, doc, n = self.kind, self.doc, len(self.kind)
        seen = np.zeros(self.n_docs, bool)
        seen[doc] = True
        self.bad |= ~seen
        if not n:
            return
        edge = np.concatenate([[True], doc[1:] != doc[:-1]])
        prev = np.where(edge, -1, np.concatenate([[0], kind[:-1]]))
        nxt = np.where(np.concatenate([edge[1:], [True]]), -1, np.concatenate([kind[1:], [0]]))
        value = (kind == _STR) | (kind == _ATOM) | (kind <= _OPEN_O)
        container = np.where(self.parent >= 0, kind[self.parent], -1)  # -1: top level
        in_o, in_a, top = container == _OPEN_O, container == _OPEN_A, container == -1
        closes = (kind == _CLOSE_A) | (kind == _CLOSE_O)
        prev_value = (prev == _STR) | (prev == _ATOM) | (prev == _CLOSE_A) | (prev == _CLOSE_O)
        bad = np.zeros(n, bool)
        bad |= value & top & (prev != -1)  # one value only
        bad |= value & in_a & ~((prev == _OPEN_A) | (prev == _SEP))
        bad |= value & in_o & ~((prev == _PAIR) | ((kind == _STR) & (nxt == _PAIR) & ((prev == _OPEN_O) | (prev == _SEP))))
        bad |= (kind == _PAIR) & ~(in_o & (prev == _STR))
        bad |= (kind == _SEP) & ~(~top & prev_value)
        bad |= closes & ~(prev_value | (prev == _OPEN_A) | (prev == _OPEN_O))
        # a string right before ':' must be a key, and a key must be one
        before2 = np.where(edge | np.concatenate([[True], edge[:-1]]), -1, np.concatenate([[0, 0], kind[:-2]])[:n])
        bad |= (kind == _PAIR) & ~((before2 == _OPEN_O) | (before2 == _SEP))
        # in an object, what follows a value after ':' is ',' or '}' (checked by the rules above);
        # a key that is followed by nothing fails here
        bad |= in_o & (kind == _STR) & ((prev == _OPEN_O) | (prev == _SEP)) & (nxt != _PAIR)
        self.bad[np.unique(doc[bad])] = True
        for i in np.flatnonzero(kind == _ATOM):
            if not self.bad[doc[i]] and not _SCALAR.match(self.buf[self.start[i] : self.end[i]]):
                self.bad[doc[i]] = True
        if escapes.any():
            # documents with escapes: find a malformed one, skipping escaped backslashes
            for d in np.unique(np.searchsorted(self.starts, np.flatnonzero(escapes), "right") - 1):
                if not self.bad[d]:
                    s = self.starts[d]
                    e = self.starts[d + 1] - 1 if d + 1 < self.n_docs else len(self.buf) - 1
                    if _BAD_ESCAPE.search(self.buf[s:e].replace(b"\\\\", b"")):
                        self.bad[d] = True

    # ---- access by token number -------------------------------------------------
    def text(self, i: int) -> bytes:
        e = self.end[self.partner[i]] if self.kind[i] <= _OPEN_O else self.end[i]
        return self.buf[self.start[i] : e]

    def string(self, i: int) -> str:
        raw = self.buf[self.start[i] + 1 : self.end[i] - 1]
        if b"\\" in raw:
            return json.loads(self.buf[self.start[i] : self.end[i]])
        return raw.decode("utf-8", "replace")

    def is_null(self, i: int) -> bool:
        return self.kind[i] == _ATOM and self.buf[self.start[i] : self.end[i]] == b"null"


class _Tree:
    """Children of containers, from one sort of the tokens by parent."""

    def __init__(self, ix: Index):
        self.ix = ix
        kind = ix.kind
        n = len(kind)
        value = (kind == _STR) | (kind == _ATOM) | (kind <= _OPEN_O)
        nxt_pair = np.concatenate([kind[1:] == _PAIR, [False]]) if n else np.zeros(0, bool)
        is_key = (kind == _STR) & nxt_pair
        self.members = np.flatnonzero(value & ~is_key)
        par = ix.parent[self.members]
        order = np.argsort(par, kind="stable")
        self.members = self.members[order]
        self.par = par[order]
        self.first = np.searchsorted(self.par, np.arange(-1, n + 1)).tolist()

    def children(self, i: int) -> np.ndarray:
        return self.members[self.first[i + 1] : self.first[i + 2]]

    def roots(self) -> np.ndarray:
        return self.children(-1)

    def key(self, i: int) -> str:
        return self.ix.string(i - 2)


@functools.lru_cache(4096)
def _norm_key(k: str) -> str:
    return re.sub(r"[^a-z]", "", k.lower())


@functools.lru_cache(4096)
def _norm_raw(quoted: bytes) -> str:
    """A key as it stands in the text, quotes and escapes included, in its normal spelling."""
    return _norm_key(json.loads(quoted) if b"\\" in quoted else quoted[1:-1].decode("utf-8", "replace"))


_ID = "criterionid"


class _Node:
    """A value somewhere in an index; text inside strings moves to the index of the next pass."""

    __slots__ = ("tree", "i")

    def __init__(self, tree: _Tree, i: int):
        self.tree, self.i = tree, i

    @property
    def kind(self) -> int:
        return int(self.tree.ix.kind[self.i])


def _resolve(nodes: list[_Node | None]) -> list[_Node | None]:
    """Replace strings by what they encode, all of one pass in one index; nothing where they encode nothing."""
    out = list(nodes)
    while True:
        todo = [k for k, x in enumerate(out) if x is not None and x.kind == _STR]
        if not todo:
            return out
        texts = [out[k].tree.ix.string(out[k].i).encode("utf-8", "replace") for k in todo]
        ix = Index(texts)
        tree = _Tree(ix)
        root = {int(ix.doc[r]): int(r) for r in tree.roots()}
        for d, k in enumerate(todo):
            out[k] = None if ix.bad[d] or d not in root else _Node(tree, root[d])


def _elements(node: _Node | None) -> list[tuple[int, _Node, str | None]]:
    """``(pos, element, id it is keyed by)``; null elements leave a gap."""
    if node is None or node.kind == _ATOM:
        return []
    tree, ix = node.tree, node.tree.ix
    kids = tree.children(node.i)
    if node.kind == _OPEN_A:
        return [(p, _Node(tree, int(c)), None) for p, c in enumerate(kids) if not ix.is_null(c)]
    keys = [tree.key(c) for c in kids]
    # an object of objects is keyed by id, unless it carries the fields of one element
    keyed = len(kids) > 0 and all(ix.kind[c] == _OPEN_O or ix.is_null(c) for c in kids) and any(ix.kind[c] == _OPEN_O for c in kids)
    if keyed and not any(_norm_key(k) in (_ID, "score", "description", "name") for k in keys):
        return [(p, _Node(tree, int(c)), k) for p, (c, k) in enumerate(zip(kids, keys)) if not ix.is_null(c)]
    if not len(kids):
        return []
    return [(0, node, None)]


def _member(node: _Node | None, name: str) -> _Node | None:
    """The member of an object under a key in any spelling; the last one if it is repeated."""
    if node is None or node.kind != _OPEN_O:
        return None
    ix = node.tree.ix
    for c in node.tree.children(node.i)[::-1].tolist():
        if _norm_raw(ix.buf[ix.start[c - 2] : ix.end[c - 2]]) == name:
            return _Node(node.tree, c)
    return None


def _unwrap(nodes: list[_Node | None]) -> list[_Node | None]:
    """Step through envelopes, however many, until the object that holds the rubric or the evaluation.

    Each step goes one level deeper, so it ends with the depth of the deepest payload.
    """
    out = list(nodes)
    while True:
        moved: list[int] = []
        for k, x in enumerate(out):
            if x is None:
                continue
            if x.kind == _OPEN_A:
                kids = x.tree.children(x.i)
                out[k] = _Node(x.tree, int(kids[0])) if len(kids) == 1 else None
                moved.append(k)
            elif x.kind == _OPEN_O and _member(x, "rubric") is None and _member(x, "goldevaluation") is None:
                inner = _member(x, "record") or _member(x, "payload") or _member(x, "data")
                out[k] = inner
                moved.append(k)
            elif x.kind == _ATOM:
                out[k] = None
        if not moved:
            return out
        out = _resolve(out)


def _id_of(node: _Node, keyed: str | None) -> str | None:
    x = _member(node, _ID)
    if x is not None and x.kind == _STR:
        return x.tree.ix.string(x.i)
    if x is not None and x.kind == _ATOM and not x.tree.ix.is_null(x.i):
        return x.tree.ix.text(x.i).decode()
    return keyed


def _lists(nodes: list[_Node | None]) -> list[list[tuple[int, _Node, str | None]]]:
    """Elements of each list; elements that are themselves strings are resolved too."""
    lists = [_elements(x) for x in _resolve(nodes)]
    flat = _resolve([e for els in lists for _, e, _ in els])
    it = iter(flat)
    return [[(p, e2, k) for p, _, k in els if (e2 := next(it)) is not None] for els in lists]


def nested_rows(ids: list[int], payloads: list[bytes | None], bodies: bool = True) -> dict[str, list]:
    """All linked rows of a batch of payloads, as columns of ``ELEMENT_SCHEMA``."""
    cols: dict[str, list] = {k: [] for k in ("doc", "child", "parent_pos", "pos", "element_id", "parent_id", "body")}
    keep = [k for k, p in enumerate(payloads) if p]
    ix = Index([payloads[k] for k in keep])
    tree = _Tree(ix)
    root = {int(ix.doc[r]): int(r) for r in tree.roots()}
    tops: list[_Node | None] = [None if ix.bad[d] or d not in root else _Node(tree, root[d]) for d in range(len(keep))]
    tops = _unwrap(_resolve(tops))
    rubric = _resolve([_member(x, "rubric") for x in tops])
    gold = _resolve([_member(x, "goldevaluation") for x in tops])
    criteria = _lists([_member(x, "criteria") for x in rubric])
    results = _lists([_member(x, "criterionresults") for x in gold])
    anchors = iter(_lists([_member(c, "scoringanchors") for cs in criteria for _, c, _ in cs]))

    def put(doc: int, child: str, parent: int, pos: int, eid: str | None, pid: str | None, x: _Node) -> None:
        for k, v in zip(cols, (doc, child, parent, pos, eid, pid, x.tree.ix.text(x.i).decode("utf-8", "replace") if bodies else None)):
            cols[k].append(v)

    for d, k in enumerate(keep):
        first: dict[str, int] = {}
        for pos, c, keyed in criteria[d]:
            cid = _id_of(c, keyed)
            if cid is not None:
                first.setdefault(cid, pos)
            put(ids[k], "criteria", -1, pos, cid, None, c)
            for apos, a, _ in next(anchors):
                put(ids[k], "scoring_anchors", pos, apos, None, cid, a)
        for pos, r, keyed in results[d]:
            rid = _id_of(r, keyed)
            put(ids[k], "criterion_results", first.get(rid, -1) if rid is not None else -1, pos, rid, rid, r)
    return cols


def flatten_payloads(df: DataFrame, key: str, payload: str, bodies: bool = True) -> DataFrame:
    """Linked rows of JSON payloads: ``(key, child, parent_pos, pos, element_id, parent_id, body)``.

    ``child`` is ``criteria``, ``scoring_anchors`` or ``criterion_results``; ``pos`` is the
    place in its own list; ``parent_pos`` is -1 for a criterion, the criterion's place for
    an anchor, and for a result the place of the first criterion with exactly its id, else
    -1.  ``body`` is the element's own JSON (null with ``bodies=False``).  Null, empty and
    unreadable payloads give no row; repeated payloads give rows under each key.  One
    narrow pass without shuffle; other columns of ``df`` are not read.
    """
    schema = pa.schema([("doc", pa.int64()), ("child", pa.string()), ("parent_pos", pa.int32()), ("pos", pa.int32()), ("element_id", pa.string()), ("parent_id", pa.string()), ("body", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            s = 0
            while s < len(ids):
                e, size = s, 0
                while e < len(ids) and (e == s or size + len(texts[e]) <= CHUNK_BYTES):
                    size += len(texts[e])
                    e += 1
                got = nested_rows(ids[s:e], texts[s:e], bodies)
                s = e
                if got["doc"]:
                    yield pa.RecordBatch.from_pydict(got, schema)

    src = df.select(F.col(key).cast("bigint").alias("doc"), F.col(payload).cast("binary").alias("p")).where(F.col("p").isNotNull())
    return spread(src).mapInArrow(run, ELEMENT_SCHEMA).withColumnRenamed("doc", key)


def flatten_typed(records: DataFrame, key: str) -> DataFrame:
    """The same three tables from typed records (``rubric.criteria`` and ``gold_evaluation``).

    Null elements keep their place without a row, null lists give none.  All JVM-side.
    """
    crit = records.select(key, F.col("rubric.criteria").alias("cs"), F.col("gold_evaluation.criterion_results").alias("rs"))
    c = crit.select(key, F.posexplode("cs").alias("pos", "c")).where("c is not null")
    out = c.select(key, F.lit("criteria").alias("child"), F.lit(-1).alias("parent_pos"), "pos", F.col("c.criterion_id").alias("element_id"))
    a = c.select(key, F.col("pos").alias("parent_pos"), F.posexplode("c.scoring_anchors").alias("pos", "a")).where("a is not null")
    a = a.select(key, F.lit("scoring_anchors").alias("child"), "parent_pos", "pos", F.lit(None).cast("string").alias("element_id"))
    ids = F.transform("cs", lambda x: x["criterion_id"])
    r = crit.select(key, ids.alias("ids"), F.posexplode("rs").alias("pos", "r")).where("r is not null")
    place = F.coalesce(F.array_position("ids", F.col("r.criterion_id")) - 1, F.lit(-1)).cast("int")
    r = r.select(key, F.lit("criterion_results").alias("child"), place.alias("parent_pos"), "pos", F.col("r.criterion_id").alias("element_id"))
    return out.unionByName(a).unionByName(r)
