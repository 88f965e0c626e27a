"""Repair of the structure of conversations, over a suffix-shared automaton of signatures.

A row's sign says whose it is and what is wrong with it; a conversation's signature is the
signs of its rows in order. What the rest of a repair costs depends on the signs that are
left and on the state of the grammar alone. So conversations with equal ends share them: a
node of the automaton stands for one such end, however many conversations have it, and
holds for each state of the grammar the least cost to go and the first edit of the best
audit, which leads on to a state of the same node or of the next one. That is the best
suffix of an audit, written once.

Signatures are sorted from their ends and dealt out by ranges, so equal ends lie together,
within a task and nowhere else but where a range is cut. A task makes the nodes in order
and holds only those on the path to the signature at hand; the next one keeps the part of
the path that it shares. Equal signatures are told apart by the conversation's id when
ranges are cut, so one that a third of all conversations have is not one task's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_arrow, kept, table
from tidemark.operators.scale import lookup_join

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3  # costs of edits, and of a truncated row that stays
#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
#: The state after the row that may be made in a state: there is one only.
TURN = (USER, USER, ASSISTANT, USER)
FAR = 1 << 60
_END = [(0, "") if s in ACCEPTING else (FAR, "") for s in range(4)]
#: Signs: whose a row is, in upper case if it is truncated; `d` for one that must go.
GONE, OTHER = "d", "x"
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
#: White space: blank, and tab to carriage return.
BLANKS = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")

Node = list[tuple[int, str]]


def _with_inserts(node: Node) -> Node:
    """Rows made before the next one; of edits that cost the same the least letter wins."""
    for _ in range(2):  # a made user may need a made assistant, and the other way round
        node = [min(best, (INSERT + node[TURN[s]][0], "I")) for s, best in enumerate(node)]
    return node


END = _with_inserts(_END)


def before(sign: str, rest: Node) -> Node:
    """The node of an end that starts with `sign` and goes on as `rest`: for each state of
    the grammar the least cost to go, and the first edit."""
    whose, extra = sign.lower(), CUT if sign.isupper() else 0
    node = []
    for state in range(4):
        edits = [(DELETE + rest[state][0], "D")]
        if whose != GONE:
            if (after := _KEPT.get((whose, state))) is not None:
                edits.append((extra + rest[after][0], "K"))
            edits.append((REROLE + extra + rest[TURN[state]][0], "R"))
        node.append(min(edits))
    return _with_inserts(node)


def audit(signature: str, path: list[Node]) -> str:
    """The first edits along a signature; `path` holds the nodes of its ends, longest last."""
    state, left, edits = START, len(signature), []
    while edit := path[left][state][1]:
        edits.append(edit)
        if edit != "I":
            sign = signature[len(signature) - left].lower()
            left -= 1
        if edit == "K":
            state = _KEPT[sign, state]
        elif edit != "D":
            state = TURN[state]
    return "".join(edits)



def _repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs and audits of signatures that come sorted from their ends."""
    last, path = "", [END]
    edits = audit("", path)
    for batch in batches:
        costs, audits = [], []
        for turned in batch.column(batch.schema.names.index("turned")).to_pylist():
            if turned != last:
                same = 0
                while same < min(len(turned), len(last)) and turned[same] == last[same]:
                    same += 1
                del path[same + 1 :]
                for sign in turned[same:]:
                    path.append(before(sign, path[-1]))
                last, edits = turned, audit(turned[::-1], path)
            costs.append(path[-1][START][0])
            audits.append(edits)
        rest = [n for n in batch.schema.names if n != "turned"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(batch.schema.names.index(n)) for n in rest],
             pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            [*rest, "cost", "audit"],
        )


class _Told:
    """What is told of one conversation, from its rows in order."""

    def __init__(self, conv: str) -> None:
        self.conv, self.signs, self.faults = conv, [], [0, 0, 0]
        self.first = self.newest = self.initial = self.turn = self.digest = None
        self.distinct = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: int, again: bool, digest: bytes) -> None:
        if fault != 1 and (again or (self.digest == digest and self.turn == turn)):
            fault = 2
        if fault:
            self.faults[fault - 1] += 1
        whose = initial if initial in ("s", "u", "a") else OTHER
        self.signs.append(GONE if fault in (1, 2) else whose.upper() if fault else whose)
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        if turn is not None and turn != self.newest:
            self.first = turn if self.first is None else self.first
            self.newest, self.distinct = turn, self.distinct + 1
        self.initial, self.turn, self.digest = initial, turn, digest

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.newest - self.first + 1 - self.distinct
        return self.conv, "".join(reversed(self.signs)), gaps, *self.faults, self.illegal


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures, from their ends, and counts of conversations whose rows come in order."""

    def batch_of(done: list[_Told]) -> pa.RecordBatch:
        columns = zip(*[told.row() for told in done], strict=True)
        kinds = [pa.string(), pa.string(), *[pa.int64()] * len(COUNTS)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["_conv", "turned", *COUNTS]
        )

    told = None
    for batch in batches:
        done = []
        for conv, *rest in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if told is None or told.conv != conv:
                if told is not None:
                    done.append(told)
                told = _Told(conv)
            told.add(*rest)
        if done:
            yield batch_of(done)
    if told is not None:
        yield batch_of([told])


class _Repair:
    """Rows of one conversation as its audit goes through them."""

    def __init__(self, conv: str, edits: str) -> None:
        self.conv, self.edits, self.at, self.state, self.place = conv, edits, 0, START, 0

    def _put(self, role: str | None, text: str) -> tuple[str, int, str, str]:
        """A row; without a role it gets the one that its state asks for."""
        after = TURN[self.state] if role is None else _KEPT[role[:1], self.state]
        self.state, self.place = after, self.place + 1
        return self.conv, self.place - 1, role or ("user" if after == USER else "assistant"), text

    def made(self) -> Iterator[tuple[str, int, str, str]]:
        while self.edits[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._put(None, "")

    def add(self, role: str, text: str) -> Iterator[tuple[str, int, str, str]]:
        yield from self.made()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(role if edit == "K" else None, text)


#: Rows of a batch that is handed on, and characters of text after which it is, too.
ROWS, CHARS = 1000, 1 << 20


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired rows, from an audit and then the rows in order of each conversation."""
    kinds = {"_conv": pa.string(), "place": pa.int64(), "role": pa.string(), "text": pa.string()}

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds)
        )

    now, out, size = None, [], 0
    for batch in batches:
        for conv, edits, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if edits is not None:
                if now is not None:
                    out += now.made()
                now = _Repair(conv, edits)
            else:
                out += now.add(role, text)
                size += len(text)
            if len(out) >= ROWS or size >= CHARS:
                if out:
                    yield batch_of(out)
                out, size = [], 0
    if now is not None:
        out += now.made()
    if out:
        yield batch_of(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of `role:text`, joined by newlines, of conversations whose rows come in order."""
    now, digest = None, hashlib.sha256()

    def batch_of(done: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done, strict=True)], ["_conv", "digest"])

    for batch in batches:
        done = []
        for conv, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if conv != now:
                if now is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([(now, digest.hexdigest())])


#: Stands for a null id among ids as text, of which none can hold it.
NO_ID = "\0"


def _key(conv_id: str) -> Column:
    return F.coalesce(F.col(f"`{conv_id}`").cast("string"), F.lit(NO_ID))


def _id(kind: T.DataType) -> Column:
    return F.when(F.col("_conv") != NO_ID, F.col("_conv").cast(kind))


def _plain(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """`_conv`, `_turn`, `_role`, `_text`, nulls of the last two as one blank."""
    values = {"_role": F.col(f"`{role}`"), "_text": F.col(f"`{text}`")}
    return df.select(
        _key(conv_id).alias("_conv"),
        F.col(f"`{turn}`").cast("long").alias("_turn"),
        *[F.coalesce(c.cast("string"), F.lit(" ")).alias(n) for n, c in values.items()],
    )


#: Rows of a conversation go by turn, null first; those of one turn by role and text.
ORDER = (F.asc_nulls_first, ("_turn", "_role", "_text"))


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    how, columns = ORDER
    return rows.repartition("_conv").sortWithinPartitions("_conv", *first, *[how(c) for c in columns])


def audits(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row a conversation: `conv_id`; `gaps`, the turns that lack between its first and
    its last; rows that are `blank`, `duplicate` or `truncated`, each counted for its first
    fault; `illegal` neighbours; the `cost` of its cheapest repair and the `audit` of it.

    Blank is a text without any but white space, duplicate a row whose role and text came
    earlier, truncated one whose last such character doesn't end a sentence. A repair makes
    the initials of the roles `(s?(ua)+)?`. Keep costs nothing, Rerole (to user or
    assistant) 3, Delete 4, Insert (an empty user or assistant) 3; blank and duplicate rows
    must go, truncated ones that stay add 3. The audit holds the initials of the edits in
    order, the least in ASCII of the cheapest ones.

    Rows go by turn, null first, those of one turn by role and text; a null role or text is
    one blank. A null id is a conversation, too. An empty table gives no rows; other columns
    are not looked at. A conversation is read in order by one task, which keeps one sign a
    row of it, as its audit does.
    """
    rows = _plain(df, conv_id, turn, role, text)
    # Digests as keys: texts are told apart by 256 bits of SHA-2.
    size = [F.octet_length(c).cast("string") for c in ("_conv", "_role")]
    rows = rows.withColumn("digest", F.sha2(F.concat_ws(":", *size, "_conv", "_role", "_text"), 256))
    seen = rows.groupBy("digest").agg(
        F.min(F.struct(F.col("_turn").isNotNull().alias("known"), "_turn")).alias("first"), F.count("*").alias("times")
    )
    several = kept(seen.filter("times > 1").select("digest", "first"))
    later = F.struct(F.col("_turn").isNotNull().alias("known"), "_turn") > F.col("first")
    marked = lookup_join(rows, several, "digest").withColumn("again", F.coalesce(later, F.lit(False)))
    body = F.rtrim("_text", F.lit(BLANKS))
    fault = F.when(body == "", 1).when(F.substring(body, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    signs = _in_order(marked).select(
        "_conv", "_turn", F.substring("_role", 1, 1).alias("initial"), fault.cast("long").alias("fault"), "again", "digest"
    )
    counts = ", ".join(f"{c} long" for c in COUNTS)
    told = kept(in_arrow(signs, _signatures, f"_conv string, turned string, {counts}"))
    dealt = told.repartitionByRange("turned", "_conv").sortWithinPartitions("turned", "_conv")
    best = in_arrow(dealt, _repairs, f"_conv string, {counts}, cost long, audit string")
    return best.select(_id(df.schema[conv_id].dataType).alias(conv_id), *COUNTS, "cost", "audit")


def _repaired(
    df: DataFrame, audited: DataFrame, conv_id: str, turn: str, role: str, text: str
) -> DataFrame:
    rows = _plain(df, conv_id, turn, role, text).withColumn("_audit", F.lit(None).cast("string"))
    heads = audited.select(_key(conv_id).alias("_conv"), F.col("audit").alias("_audit"))
    both = rows.unionByName(heads, allowMissingColumns=True).withColumn("_row", F.col("_audit").isNull())
    placed = _in_order(both, "_row").select("_conv", "_audit", "_role", "_text")
    return in_arrow(placed, _apply, "_conv string, place long, role string, text string")


def repaired(
    df: DataFrame,
    audited: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """`conv_id`, `place` (from 0), `role` and `text` of all rows after the repairs of
    `audits`. A conversation of which nothing is left has no rows."""
    done = _repaired(df, audited, conv_id, turn, role, text)
    return done.select(
        _id(df.schema[conv_id].dataType).alias(conv_id), "place", F.col("role").alias(role), F.col("text").alias(text)
    )


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with rows that are lost, empty, cut, doubled or another's, by a hash of
    their id and turn: what the query repairs. Nulls are one blank there and in texts."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = df.select(
        "conv_id",
        "turn",
        *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")],
        (F.crc32(name.cast("binary")) % 20).alias("_how"),
    )
    how = F.col("_how")
    rows = rows.filter(how != 0)
    text = F.when(how == 1, "").when(how == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(how == 4, "user").otherwise(F.col("role"))
    times = F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time"))
    return made.drop("_time")


def op12_suffix_shared_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the repair of all damaged conversations costs, its audit, and a digest."""
    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    audited = kept(audits(rows))
    names = ("conv_id", "turn", "role", "text")
    texts = in_arrow(
        _repaired(rows, audited, *names).select("_conv", "role", "text"), _digests, "_conv string, digest string"
    )
    all_ids = given.select(_key("conv_id").alias("_conv")).distinct()
    reports = audited.withColumn("_conv", _key("conv_id")).drop("conv_id")
    joined = all_ids.join(reports, "_conv", "left").join(texts, "_conv", "left")
    return joined.select(
        _id(given.schema["conv_id"].dataType).alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*COUNTS, "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _oracle() -> str:
    """Values of (cost, audit) are written as one text, the cost in nine digits, so that the
    least text is the cheapest and then the first in ASCII."""

    def edit(letter: str, cost: str, value: str) -> str:
        return f"printf('%09d', left({value}, 9)::INT + {cost}) || '{letter}' || substr({value}, 10)"

    far = "'900000000'"
    goes, cut = "s = 'd'", "CASE WHEN s = upper(s) THEN 3 ELSE 0 END"

    def base(state: int) -> str:
        kept = [f"WHEN lower(s) = '{who}' THEN {edit('K', cut, f'v{to}')}" for (who, at), to in _KEPT.items() if at == state]
        keep = f"CASE WHEN {goes} THEN {far} {' '.join(kept)} ELSE {far} END"
        rerole = f"CASE WHEN {goes} THEN {far} ELSE {edit('R', f'3 + {cut}', f'v{TURN[state]}')} END"
        return f"least({edit('D', '4', f'v{state}')}, {keep}, {rerole})"

    def made(own: str, other: str) -> str:
        return f"least({own}, {edit('I', '3', other)})"

    return rf"""
WITH RECURSIVE z AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS z
), g AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
      lambda c: ascii(c)::BIGINT), lambda c, b: xor(c // 256, z[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 20 AS how
  FROM conversations, z
), r AS (
  SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE how WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM g WHERE how <> 0
), m AS (
  SELECT *, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nth
  FROM r
), f AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY nth) || initial AS pair
  FROM m
), t AS (
  SELECT *, CASE WHEN fault IN (1, 2) THEN 'd' WHEN fault = 3 THEN upper(whose) ELSE whose END AS sign
  FROM (SELECT *, CASE WHEN initial IN ('s', 'u', 'a') THEN initial ELSE 'x' END AS whose FROM f)
), c AS (
  SELECT conv_id, string_agg(sign, '' ORDER BY nth) AS signs, count(*) AS n,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM t GROUP BY conv_id
), b AS (
  SELECT DISTINCT signs FROM c
), n AS (
  SELECT signs, length(signs) AS n_left, '000000000' AS v0, '000000006II' AS v1, '000000003I' AS v2, '000000000' AS v3
  FROM b
  UNION ALL
  SELECT signs, n_left - 1, {made("e0", "u")}, {made("e1", "u")}, u, a FROM (
    SELECT *, {made("e2", "e3")} AS u, {made("e3", "e2")} AS a FROM (
      SELECT signs, n_left, {base(0)} AS e0, {base(1)} AS e1, {base(2)} AS e2, {base(3)} AS e3
      FROM (SELECT *, substr(signs, n_left, 1) AS s FROM n WHERE n_left > 0)))
), w AS (
  SELECT conv_id, left(v0, 9)::BIGINT AS cost, substr(v0, 10) AS audit FROM c JOIN n ON n.signs = c.signs AND n_left = 0
), y AS (
  SELECT conv_id, audit, 0 AS done, 0 AS nth, '' AS last, [] :: VARCHAR[] AS made FROM w
  UNION ALL
  SELECT conv_id, audit, done + 1, nth, CASE WHEN edit = 'D' THEN last ELSE left(whose, 1) END,
    CASE WHEN edit = 'D' THEN made ELSE list_append(made, whose || ':' || text) END
  FROM (
    SELECT y.conv_id, audit, done, edit, made, last, y.nth + CASE WHEN edit = 'I' THEN 0 ELSE 1 END AS nth,
      CASE WHEN edit = 'K' THEN role WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS whose,
      CASE WHEN edit = 'I' THEN '' ELSE text END AS text
    FROM (SELECT *, substr(audit, done + 1, 1) AS edit FROM y WHERE done < length(audit)) y
      LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM y.conv_id AND t.nth = y.nth + 1)
), q AS (
  SELECT conv_id, sha256(array_to_string(made, chr(10))) AS repaired_sha256 FROM y WHERE done = length(audit)
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
  LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM i.conv_id
  LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM i.conv_id
"""


ORACLE = _oracle()
