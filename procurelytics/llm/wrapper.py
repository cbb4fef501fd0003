"""Main text of web pages by wrapper inference.

A page is a stream of tags and texts.  Repeated neighbours fold into groups; the streams of a host's pages
of one shape are aligned one after the other, where a text that differs becomes a slot, a part that one
stream lacks becomes optional, and repetitions become groups.  The result is a union-free regular
expression, the wrapper.  Tags, or else the weight of texts, name the container of the article; each page
is matched against its wrapper, and the texts inside the container, without menus and the like and without
those that the wrapper holds constant, are the main text.

Every task folds its pages into one wrapper per host and shape before anything is shuffled, so a host with
a third of all pages sends one small row per task."""

from __future__ import annotations

import html
import json
import re
from difflib import SequenceMatcher
from functools import lru_cache
from hashlib import blake2b
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from procurelytics.llm.common import bounded_batches, whole_text
from procurelytics.session import cut_lineage

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.I | re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body center div main section table tbody td tr".split())
LEFT_OUT = frozenset("aside audio button canvas dialog footer form head header iframe menu nav object option select svg video".split())
LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu modal nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promoted recommended related replies reply search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
LEFT_OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search".split())
#: Tags whose names say what they hold, whatever their class.
OWN_NAME = frozenset("article main body html h1 h2 h3 h4 h5 h6".split())
#: Longest group of tokens that is folded, and most optional neighbours that stand in their own order.
GROUP = 12
#: Cells of an alignment beyond which the longest common stream is not sought: matching blocks serve.
CELLS = 4_000_000
#: Share of the text of a host's pages that name no article which the container must hold.
MOST = 0.6
#: Different pages of a host and shape that must share a text for it to be the template's, not an article's.
TEMPLATE = 20
#: Page streams of a host that wait for their alignment.
WAITING = 1000
SLOT = "#"


def _names(attributes: str):
    """Words of class and id, and the role."""
    words, roles, label = set(), set(), ""
    for kind, *values in _NAMES.findall(attributes):
        value = "".join(values).lower()
        if kind.lower() == "role":
            roles.update(value.split())
        else:
            words.update(re.findall(r"[a-z]+", value))
            label += "." + re.sub(r"[^a-z]+", "-", value)
    return words, roles, label


def walk(page: str):
    """(tokens, texts): the stream of labels with SLOT for texts; per text the place of its slot, the labels of the containers around it, whether it is left out or a link, and the raw text.
    Block borders are texts of one blank."""
    tokens, texts, stack, at = [], [], [], 0

    def text(raw):
        texts.append((len(tokens) - bool(tokens and tokens[-1] == SLOT), tuple(s[2] for s in stack if s[2]), any(s[1] for s in stack), any(s[0] == "a" for s in stack), raw))
        if raw.strip() and (not tokens or tokens[-1] != SLOT):
            tokens.append(SLOT)

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            text(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            texts.append((len(tokens), (), any(s[1] for s in stack), False, " "))
        if m[2]:
            if any(s[0] == name for s in stack):
                while stack.pop()[0] != name:
                    pass
                tokens.append("/" + name)
            continue
        words, roles, label = _names(m[4]) if m[4] else (set(), set(), "")
        out = name in LEFT_OUT or bool(roles & LEFT_OUT_ROLES) or (name not in OWN_NAME and bool(words & LEFT_OUT_WORDS)) or bool(m[4] and _HIDDEN.search(m[4]))
        if "main" in roles:
            name_label = "main"
        else:
            name_label = name
        tokens.append(("-" if out else "") + name_label + label)
        if name not in VOID and not m[4].endswith("/"):
            if name in ("p", "li", "td", "th", "tr", "option", "dt", "dd") and stack and stack[-1][0] == name:
                stack.pop()
            stack.append((name, out, (name_label + label) if name in CONTAINERS or name_label == "main" else ""))
    if at < len(page):
        text(page[at:])
    return tokens, texts


def marked(tokens: list, texts: list) -> list:
    """The stream with each text as SLOT and its hash."""
    words: dict[int, list] = {}
    for place, _, _, _, raw in texts:
        if raw.strip():
            words.setdefault(place, []).extend(raw.split())
    out = list(tokens)
    for place, found in words.items():
        out[place] = SLOT + blake2b(" ".join(found).encode("utf-8", "replace"), digest_size=8).hexdigest()
    return out


def _bare(items: list) -> list:
    """Every text as SLOT."""
    return [SLOT if isinstance(item, str) and item.startswith(SLOT) else item for item in items]


def _both(a: list, b: list) -> list:
    """Two streams that differ in texts only: those become slots."""
    return [x if x == y else SLOT for x, y in zip(a, b)]


def fold(items: list) -> list:
    """Neighbouring equal groups become one repeated group ["+", ...], neighbours of a repeated group
    that equal it are taken in; a group does not begin with the end of an element.  Texts count as
    equal; inside a group they are slots."""
    out, own = [], []  # own: the items with their texts' hashes
    for item, bare in zip(items, _bare(items)):
        out.append(bare)
        own.append(item)
        again = True
        while again:
            again = False
            for n in range(1, min(GROUP, len(out) - 1) + 1):
                tail, before = out[-n:], out[-n - 1]
                if isinstance(tail[0], str) and (tail[0].startswith("/") or tail[0] == SLOT):
                    continue
                if before == ["+", *tail]:  # one more of the group
                    del out[-n:]
                    again = True
                elif n == 1 and isinstance(tail[0], list) and isinstance(before, list) and before[1:] == tail[0][1:]:
                    out[-2:] = [["+", *before[1:]]]
                    again = True
                elif len(out) >= 2 * n and out[-2 * n : -n] == tail:
                    out[-2 * n :] = [["+", *tail]]
                    again = True
                if again:
                    kept = len(out) - 1
                    own[kept:] = [out[kept]]
                    break
    return own


def _loose(group) -> bool:
    """Is it a repeated choice ["+", ["?", ...], ["?", ...]]: any parts in any order."""
    return isinstance(group, list) and len(group) > 1 and all(isinstance(part, list) and part[0] == "?" for part in group[1:])


def _instances(items: list, of: list) -> list:
    """``items`` where parts that are instances of groups of ``of`` stand as those groups."""
    groups = sorted((g for g in of if isinstance(g, list)), key=len, reverse=True)
    bodies = [(g, sorted((part[1:] for part in g[1:]), key=len, reverse=True) if _loose(g) else None) for g in groups]

    bare = _bare(items)

    def end(i, g, parts):
        if bare[i] == g:
            return i + 1
        if parts is None:
            return i + len(g) - 1 if bare[i : i + len(g) - 1] == g[1:] else i
        if isinstance(bare[i], str) and (bare[i].startswith("/") or bare[i] == SLOT):
            return i  # as in fold, no choice begins with the end of an element
        while step := next((len(p) for p in parts if bare[i : i + len(p)] == p), 0):
            i += step
        return i

    out, i = [], 0
    while i < len(items):
        for g, parts in bodies:
            if (after := end(i, g, parts)) > i:
                out.append(g)
                i = after
                break
        else:
            out.append(items[i])
            i += 1
    return out


def _leaves(items):
    for item in items:
        if isinstance(item, list):
            yield from _leaves(item[1:])
        else:
            yield item


def gather(items: list) -> list:
    """Neighbouring optional parts of which one comes twice, or that are more than GROUP, become one
    repeated choice of the distinct parts, or of their single tokens where those are more than GROUP.
    It covers all that the parts covered, so nothing is left out and equal parts do not pile up."""
    out, run = [], []

    def close():
        bodies = [part[1:] for g in run for part in (g[1:] if _loose(g) else [g])]
        distinct = list({repr(body): body for body in bodies}.values())
        if len(run) > 1 and (len(distinct) < len(bodies) or len(run) > GROUP or any(_loose(g) for g in run)):
            if len(distinct) > GROUP:
                distinct = [[token] for token in dict.fromkeys(_leaves(chain.from_iterable(distinct)))]
            out.append(["+", *(["?", *body] for body in distinct)])
        else:
            out.extend(run)
        run.clear()

    for item in items:
        if isinstance(item, list):
            run.append(item)
        else:
            close()
            out.append(item)
    close()
    return out


def _pairs(a: list, b: list, alike) -> list:
    """Pairs of places of ``a`` and ``b`` that match, both ascending."""
    head, n = 0, min(len(a), len(b))
    while head < n and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    ends = [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    pairs = [(k, k) for k in range(head)]
    if len(x) * len(y) > CELLS:
        names = [[repr(item[1] if isinstance(item, list) else item) + "+" * isinstance(item, list) for item in side] for side in (x, y)]
        for i, j, size in SequenceMatcher(None, *names, autojunk=False).get_matching_blocks():
            pairs += [(head + i + k, head + j + k) for k in range(size)]
        return pairs + ends
    longest = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = longest[i], longest[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if alike(x[i], y[j]) else max(below[j], row[j + 1])
    i = j = 0
    while i < len(x) and j < len(y):
        if alike(x[i], y[j]):
            pairs.append((head + i, head + j))
            i, j = i + 1, j + 1
        elif longest[i + 1][j] >= longest[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs + ends


def align(a: list, b: list) -> list:
    """The least general wrapper of two: equal tokens stay, texts that differ become slots, instances of
    a group belong to it, what only one side holds becomes optional ["?", ...], groups that begin alike
    are aligned inside.  Nothing of either side is left out."""
    if a == b:
        return a
    a, b = fold(_instances(a, b)), fold(_instances(b, a))

    def alike(x, y):
        return x == y or (isinstance(x, list) and isinstance(y, list) and x[1] == y[1])

    out = []

    def optional(part):  # of one side
        plain: list = []
        for item in [*_bare(part), None]:
            if isinstance(item, str):
                plain.append(item)
                continue
            if plain:
                out.append(["?", *plain])
            plain = []
            if item is not None:
                out.append(item)  # a repeated group may also be absent

    i = j = 0
    for at, to in [*_pairs(_bare(a), _bare(b), alike), (len(a), len(b))]:
        optional(a[i:at])  # parts of the two sides are two options
        optional(b[j:to])
        i, j = at + 1, to + 1
        if at < len(a):
            x, y = a[at], b[to]
            out.append(x if x == y else SLOT if isinstance(x, str) else ["+" if "+" in (x[0], y[0]) else "?", *align(x[1:], y[1:])])
    return gather(fold(out))


def host_of(url):
    """The host of a url; NULL without one."""
    found = F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def named(texts) -> str | None:
    """'*article' or '*main' where the page itself has such an element that holds text."""
    found = {label.split(".")[0] for _, path, out, _, raw in texts if not out and raw.strip() for label in path}
    return next(("*" + name for name in ("article", "main") if name in found), None)


def _weights(texts, into: dict) -> None:
    """Characters of text outside links and left-out parts, by container path."""
    for _, path, out, link, raw in texts:
        if path and not out and not link:
            n = len(raw.strip())
            if n:
                key = ">".join(path)
                into[key] = into.get(key, 0) + n


def shape(texts) -> str:
    """The label path that holds most of a page's text, down to the element that names the article:
    pages of one template share it."""
    weights: dict[str, int] = {}
    _weights(texts, weights)
    path = max(weights, key=lambda p: (weights[p], p), default="").split(">")
    name = named(texts)
    k = next((k for k, label in enumerate(path, 1) if name and label.split(".")[0] == name[1:]), len(path))
    return ">".join(path[:k])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrappers, container): the wrapper of each shape of a host's pages that TEMPLATE different
    pages share, as JSON, and the label path of the container that holds the articles of its pages
    without article and main elements.  Pages without host count as one host ''."""

    def settle(entry):
        for waiting in sorted(entry[1].values(), key=repr):
            entry[0] = waiting if entry[0] is None else align(entry[0], waiting)
        entry[1].clear()
        return entry

    def learn(batches):
        known: dict[str, tuple[dict, dict]] = {}
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens, texts = walk(page.as_py())
                weights, shapes = known.setdefault(host, ({}, {}))
                if not named(texts):
                    _weights(texts, weights)
                entry = shapes.setdefault(shape(texts), [None, {}, set()])
                stream = marked(tokens, texts)
                if len(entry[2]) < TEMPLATE:
                    entry[2].add(blake2b(" ".join(stream).encode("utf-8", "replace"), digest_size=8).hexdigest())
                stream = fold(stream)
                key = json.dumps(_bare(stream))  # streams that differ in texts only need no alignment
                entry[1][key] = _both(entry[1][key], stream) if key in entry[1] else stream
                if len(entry[1]) >= WAITING:
                    settle(entry)
        rows = [(h, json.dumps({k: [settle(e)[0], sorted(e[2])] for k, e in shapes.items()}), json.dumps(c)) for h, (c, shapes) in known.items()]
        yield _batch(rows)

    def _batch(rows):
        h, w, c = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(w, pa.string()), pa.array(c, pa.string())], names=["host", "wrappers", "weights"])

    def merge(table: pa.Table) -> pa.Table:
        shapes: dict[str, list] = {}
        weights: dict[str, int] = {}
        for row in map(json.loads, table.column("wrappers").to_pylist()):
            for k, (w, seen) in row.items():
                entry = shapes.setdefault(k, [None, {}, set()])
                entry[1][json.dumps(w)] = w
                entry[2].update(seen)
        for c in table.column("weights").to_pylist():
            for path, n in json.loads(c).items():
                weights[path] = weights.get(path, 0) + n
        wrappers = {k: settle(e)[0] for k, e in shapes.items() if len(e[2]) >= TEMPLATE}
        return pa.table([pa.array([table.column("host")[0].as_py()]), pa.array([json.dumps(wrappers, sort_keys=True)]), pa.array([container(weights)], pa.string())], names=["host", "wrappers", "container"])

    source = pages.select(F.coalesce(host_of("url"), F.lit("")).alias("host"), whole_text("html").alias("html"))
    return source.mapInArrow(learn, "host string, wrappers string, weights string").groupBy("host").applyInArrow(merge, "host string, wrappers string, container string")


class Program:
    """A wrapper as an automaton.  Optional and repeated parts may be absent; the texts that all its
    pages share stand outside them, so every match passes each of them."""

    def __init__(self, wrapper: list):
        self.arc: list = [None]  # by state: token, next state, is it a shared text
        self.free: list[list[int]] = [[]]  # by state: states reached without a token
        self.constants = {t for t in wrapper if isinstance(t, str) and t.startswith(SLOT) and t != SLOT}
        self.end = self._build(wrapper, 0)
        self.known: dict = {}

    def _state(self) -> int:
        self.arc.append(None)
        self.free.append([])
        return len(self.arc) - 1

    def _build(self, items, at):
        for item in items:
            after = self._state()
            if isinstance(item, str):
                self.arc[at] = (item, after, item in self.constants)
            else:
                inner = self._state()
                self.free[at] += [inner, after]
                last = self._build(item[1:], inner)
                self.free[last] += [inner, after] if item[0] == "+" else [after]
            at = after
        return at

    def _reach(self, state, bare):
        """States reached without a token whose arc takes ``bare``; the end for None."""
        if (state, bare) not in self.known:
            seen, todo = {state: None}, [state]
            while todo:
                for s in self.free[todo.pop()]:
                    if s not in seen:
                        seen[s] = None
                        todo.append(s)
            self.known[state, bare] = [s for s in seen if (s == self.end if bare is None else self.arc[s] and (self.arc[s][0] == bare or bare == SLOT and self.arc[s][0].startswith(SLOT)))]
        return self.known[state, bare]

    def shared(self, stream: list) -> set[int]:
        """Places of the stream that the wrapper takes as its shared texts; none where it does not match."""
        states, steps = [0], []
        for token, bare in zip(stream, _bare(stream)):
            came = {}
            for s in states:
                for q in self._reach(s, bare):
                    want, after, _ = self.arc[q]
                    if want in (token, bare):
                        came.setdefault(after, (s, q))
            states = list(came)
            steps.append(came)
        at = next((s for s in states if self._reach(s, None)), None)
        found = set()
        if at is not None:
            for place in range(len(steps) - 1, -1, -1):
                at, q = steps[place][at]
                if self.arc[q][2]:
                    found.add(place)
        return found


@lru_cache(maxsize=256)
def programs(wrappers: str) -> dict[str, Program]:
    return {k: Program(w) for k, w in json.loads(wrappers).items()}


def container(weights: dict[str, int]) -> str | None:
    """The deepest container with MOST of the text of a host's pages that name no article; NULL where
    there is none."""
    total, inside = sum(weights.values()), {}
    for path, n in weights.items():
        parts = path.split(">")
        for k in range(1, len(parts) + 1):
            inside[">".join(parts[:k])] = inside.get(">".join(parts[:k]), 0) + n
    good = [(p.count(">"), p) for p, n in inside.items() if n >= MOST * total]
    return max(good)[1] if good else None


def _inside(path, wanted: str | None) -> bool:
    if wanted is None:
        return True
    if wanted.startswith("*"):
        return any(label.split(".")[0] == wanted[1:] for label in path)
    return ">".join(path[: wanted.count(">") + 1]) == wanted


def main_text(page: str, wanted: str | None, wrappers: str | None = None) -> str:
    """The text of a page inside its container, in page order, white space as single blanks: its own
    article or main element, else ``wanted``, the container of its host.  A page that lacks both is
    taken whole.  Texts that the wrapper of the page's shape holds constant are the template's, unless
    the container holds nothing else."""
    tokens, texts = walk(page)
    wanted = named(texts) or wanted
    if not any(_inside(path, wanted) for _, path, _, _, raw in texts if raw.strip()):
        wanted = None
    shared: set[int] = set()
    program = programs(wrappers).get(shape(texts)) if wrappers else None
    if program and program.constants:
        inside = {place for place, path, out, _, raw in texts if not out and raw.strip() and _inside(path, wanted)}
        stream = marked(tokens, texts)
        if any(stream[place] in program.constants for place in inside):
            shared = program.shared(stream)
            if inside <= shared:
                shared = set()
    return " ".join(html.unescape("".join(
        (raw if raw == " " or (_inside(path, wanted) and path) or wanted is None else " ") if raw == " " or place not in shared else " "
        for place, path, out, _, raw in texts if not out)).split())


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text: the main text of the whole html.

    A NULL or empty html, and one without text, give the empty text; a NULL or odd url counts as a
    host of its own kind; page_id may be NULL or repeated; one row out per row in; other columns pass
    through, one named text is replaced; an empty table stays empty.  Wrappers are a stored table: the join to pages is a
    broadcast where Spark finds it small, else a shuffle that splits hot hosts."""
    spark = pages.sparkSession
    bounded_batches(spark)
    wrappers = cut_lineage(infer_wrappers(pages.select("url", "html"))).select(F.col("host").alias("_host"), "container", "wrappers")
    names = [c for c in pages.columns if c != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    joined = pages.select(row, F.coalesce(host_of("url"), F.lit("")).alias("_host"), whole_text("html").alias("_html")).join(wrappers, "_host", "left")

    def run(batches):
        for batch in batches:
            found = [main_text(h.as_py(), c, w) for h, c, w in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["_row", "text"])

    source = joined.select("_row", "_html", "container", "wrappers")
    from pyspark.sql import types as T

    schema = T.StructType([source.schema["_row"], T.StructField("text", T.StringType())])
    return source.mapInArrow(run, schema).select("_row.*", "text")


def page_rows(pages: DataFrame) -> DataFrame:
    """The main text of every page and its number of code points."""
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
