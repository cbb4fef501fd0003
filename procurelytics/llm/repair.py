"""Conversation structure repair by the auction shortest-path algorithm.

Rows of one conversation and the four states of the role pattern ``(s?(ua)+)?`` span a lattice whose
arcs are edits with integer costs.  Every node has a price; a path grows from its origin along the arc
that is cheapest with the price of its end (extension), or, where the price of its last node is below
that, the price rises and the path loses its last node (contraction).  Prices keep
``price(i) <= cost(i, j) + price(j)`` on all arcs, so when the path arrives they are the dual optimum and
exactly the arcs of shortest paths are tight.  The tight arcs that lead to the end are then followed,
least letter first.

The lattice is priced in blocks of rows from the last to the first: the prices of a block's
entries are exact, so they stand for everything behind it.  Work is linear in the rows; a task holds one
byte of code, a digest and four prices a row of one conversation, never its texts."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from procurelytics.llm.common import bounded_batches
from procurelytics.session import cut_lineage

#: Rows priced together.
BLOCK = 16
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: States: nothing yet, after s, after u, after a.  What a new user or assistant row leads to.
STATES = 4
NEW = {0: 2, 1: 2, 2: 3, 3: 2}
NEW_ROLE = {2: "user", 3: "assistant"}
#: What a kept row of a role initial leads to.
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
ACCEPTED = (0, 3)
#: Bits of a row's code: role initial (0 other, 1 s, 2 u, 3 a), must go, truncated.
INITIALS, MUST_GO, CUT_OFF = " sua", 4, 8


def _arcs(code: int) -> list[list[tuple[str, int, int, int]]]:
    """For each state the arcs of a row with this code: letter, cost, rows passed, next state."""
    extra = TRUNCATED if code & CUT_OFF else 0
    out = []
    for q in range(STATES):
        arcs = [("D", DELETE, 1, q), ("I", INSERT, 0, NEW[q])]
        if not code & MUST_GO:
            arcs.append(("R", REROLE + extra, 1, NEW[q]))
            if (INITIALS[code & 3], q) in KEPT:
                arcs.append(("K", KEEP + extra, 1, KEPT[INITIALS[code & 3], q]))
        out.append(sorted(arcs))
    return out


ARCS = [_arcs(code) for code in range(16)]
#: After the last row: insertions, and the way out (no letter) of a state that may be the last.
END_ARCS = [[("I", INSERT, 0, NEW[q])] + ([("", 0, 1, 0)] if q in ACCEPTED else []) for q in range(STATES)]


def _levels(codes: bytes) -> list:
    return [ARCS[c] for c in codes]


def _auction(levels: list, leaving: list[int]) -> list[int]:
    """Prices of the nodes of consecutive levels (row by row, state by state), with those behind the
    last level given.  The entries' prices are exact distances; all arcs keep the dual bound."""
    last = len(levels) * STATES
    price = [0] * last + leaving
    for origin in range(min(STATES, last)):
        path = [origin]
        while path:
            node = path[-1]
            if node >= last:
                break
            base = node - node % STATES
            best, end = min((cost + price[at := base + ahead * STATES + q], at) for _, cost, ahead, q in levels[node // STATES][node % STATES])
            if price[node] < best:  # contraction
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:  # extension
                path.append(end)
    return price


def _follow(levels: list, price: list[int], state: int) -> tuple[str, int]:
    """The least letters along tight arcs from an entry to behind the last level, and the state there."""
    last = len(levels) * STATES
    tight, known = {}, set(range(last, len(price)))

    def arcs(node):
        base = node - node % STATES
        return [(letter, base + ahead * STATES + q) for letter, cost, ahead, q in levels[node // STATES][node % STATES] if price[node] == cost + price[base + ahead * STATES + q]]

    for row in range(len(levels) - 1, -1, -1):  # which nodes reach the end by tight arcs alone
        nodes = range(row * STATES, row * STATES + STATES)
        for node in nodes:
            tight[node] = arcs(node)
        grown = True
        while grown:  # insertions stay within a level
            found = {n for n in nodes if n not in known and any(end in known for _, end in tight[n])}
            known |= found
            grown = bool(found)
    node, letters = state, []
    while node < last:
        letter, node = min((letter, end) for letter, end in tight[node] if end in known)
        letters.append(letter)
    return "".join(letters), node - last


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost of the cheapest edits and, of those, the ASCII-least string of their initials."""
    blocks = [codes[i : i + BLOCK] for i in range(0, len(codes), BLOCK)]
    behind = _auction([END_ARCS], [0])
    prices, entries, settled = [], behind[:STATES], 0
    for block in reversed(blocks):
        # only differences of prices count: a block starts near zero, however much lies behind it
        low = min(entries)
        settled += low
        prices.append(_auction(_levels(block), [p - low for p in entries]))
        entries = prices[-1][:STATES]
    cost, state, audit = settled + entries[0], 0, []
    for block in blocks:
        letters, state = _follow(_levels(block), prices.pop(), state)
        audit.append(letters)
    audit.append(_follow([END_ARCS], behind, state)[0])
    return cost, "".join(audit)


# --- rows -------------------------------------------------------------------------------
SPACES = "\x20\t\n\x0b\x0c\r"


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage: rows of conv_id, turn, role, text and ``gone`` (a dropped row stays as a
    mark, so that its conversation is known).  NULL role or text is one space."""
    def text_of(column):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    key = F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return rows.withColumn("text", F.when(F.col("gone"), "").otherwise(F.col("text"))).drop("_copy")


def as_given(conversations: DataFrame) -> DataFrame:
    """Rows as they are, in the form ``repair`` takes."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.lit(False).alias("gone"),
    )


def _digest():
    """What tells a (role, text) from every other."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


AUDIT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
AUDIT_SCHEMA = pa.schema([("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])
_NONE = object()


class _Conversation:
    """What is kept of a conversation while its rows pass: codes and digests, no texts."""

    def __init__(self, conv):
        self.conv, self.codes, self.seen = conv, bytearray(), set()
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, role, digest, blank, ended):
        if turn is not None:  # rows come by turn
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = role[:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        code = max(INITIALS.find(initial), 0) if initial else 0
        if blank:
            self.blank, code = self.blank + 1, code | MUST_GO
        elif digest in self.seen:
            self.duplicate, code = self.duplicate + 1, code | MUST_GO
        elif not ended:
            self.truncated, code = self.truncated + 1, code | CUT_OFF
        self.seen.add(digest)
        self.codes.append(code)

    def row(self):
        cost, audit = cheapest_edits(bytes(self.codes))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def _audits(batches):
    """Over rows sorted by conversation and turn: one row of counts and edits each."""
    current, out = None, []

    def frame():
        made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), AUDIT_SCHEMA)], schema=AUDIT_SCHEMA)
        out.clear()
        return made

    for batch in batches:
        for conv, turn, role, digest, blank, ended, gone in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or conv != current.conv:
                if current is not None:
                    out.append(current.row())
                current = _Conversation(conv)
                if len(out) >= 1000:
                    yield frame()
            if not gone:
                current.add(turn, role, digest, blank, ended)
    if current is not None:
        out.append(current.row())
    if out:
        yield frame()


def audit(rows: DataFrame) -> DataFrame:
    """Faults, cost and edits of each conversation of ``rows`` (conv_id, turn, role, text, gone).

    A NULL conv_id is a conversation of its own; rows of one turn go by role, then by the digest of
    their text; NULL turns come first.  A conversation is one stream of slim rows (digest and flags,
    no text) through one task, since its audit is one value."""
    bounded_batches(rows.sparkSession)
    shown = F.rtrim(F.translate(F.col("text"), "\t\n\x0b\x0c\r", "     "))
    slim = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"),
        (shown == "").alias("blank"), F.right(shown, F.lit(1)).isin(".", "!", "?").alias("ended"), "gone",
    )
    dealt = slim.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest")
    return dealt.mapInArrow(_audits, AUDIT)


def _repaired(batches):
    """Over an audit followed by the rows of its conversation: the repaired rows, one after another."""
    letters, at, conv, state, place = "", 0, _NONE, 0, 0
    names = ["conv_id", "place", "role", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    out = []

    def put(role, text):
        nonlocal place
        out.append((conv, place, role, text))
        place += 1

    def inserted():
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            at, state = at + 1, NEW[state]
            put(NEW_ROLE[state], "")

    def frame():
        made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
        out.clear()
        return made

    for batch in batches:
        for given, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
            if edits is not None:
                letters, at, conv, state, place = edits, 0, given, 0, 0
            else:
                edit, at = letters[at], at + 1
                if edit == "K":
                    state = KEPT[role[:1], state]
                    put(role, text)
                elif edit == "R":
                    state = NEW[state]
                    put(NEW_ROLE[state], text)
            inserted()
            if len(out) >= 1000:
                yield frame()
    if out:
        yield frame()


def _with_audits(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Each audit at the head of its conversation's rows, in the order the audit read them."""
    bounded_batches(rows.sparkSession)
    kept = rows.where(~F.col("gone")).select("conv_id", "turn", "role", "text", _digest().alias("digest"), F.lit(None).cast("string").alias("edits"))
    both = kept.unionByName(audits.select("conv_id", F.col("audit").alias("edits")), allowMissingColumns=True)
    head = F.col("edits").isNull()
    dealt = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), head, F.col("turn").asc_nulls_first(), "role", "digest")
    return dealt.select("conv_id", "role", "text", "edits")


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text."""
    return _with_audits(rows, audits).mapInArrow(_repaired, "conv_id long, place long, role string, text string")


def _hashes(batches):
    """The running SHA-256 of each conversation's repaired rows; one conversation at a time is open."""
    conv, state, started, out = _NONE, None, False, []
    heads, done = [], 0  # an audit of which no row is left still has a hash

    def passed():
        for batch in batches:
            heads.extend(given for given, edits in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()) if edits is not None)
            yield batch

    def close():
        out.append((conv, state.hexdigest()))

    def frame():
        made = pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out])], names=["hashed_id", "repaired_sha256"])
        out.clear()
        return made

    for batch in _repaired(passed()):
        for given, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if conv is _NONE or given != conv:
                if conv is not _NONE:
                    close()
                    done += 1
                while heads[done] != given:  # conversations that nothing was left of
                    out.append((heads[done], hashlib.sha256().hexdigest()))
                    done += 1
                conv, state, started = given, hashlib.sha256(), False
            state.update((f"\n{role}:{text}" if started else f"{role}:{text}").encode("utf-8"))
            started = True
        if out:
            yield frame()
    if conv is not _NONE:
        close()
        done += 1
    out += [(h, hashlib.sha256().hexdigest()) for h in heads[done:]]
    if out:
        yield frame()


def repair_rows(conversations: DataFrame) -> DataFrame:
    """The contract's rows: damage, faults, cheapest edits and the hash of what they leave.

    An empty table gives no rows; other columns are not read; repeated rows are duplicates of each
    other.  Texts pass through a task one batch at a time."""
    rows = damage(conversations)
    audits = cut_lineage(audit(rows))
    hashes = _with_audits(rows, audits).mapInArrow(_hashes, "hashed_id long, repaired_sha256 string")
    return audits.join(hashes, audits["conv_id"].eqNullSafe(hashes["hashed_id"])).drop("hashed_id")
