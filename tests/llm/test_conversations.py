"""Repairs against a search of all edits, and the report against a plain reading of rows."""

import hashlib
import heapq
import random
import re

from tidemark.llm.conversations import END, START, _repairs, audit, audits, before, repaired


def best_by_search(signature):
    """Cheapest first, then least in ASCII: (cost, audit) by a search of all edits."""
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    queue, seen = [(0, "", 0, "")], set()
    while queue:
        cost, edits, at, last = heapq.heappop(queue)
        if at == len(signature) and last in ("", "a"):
            return cost, edits
        if (at, last) in seen:
            continue
        seen.add((at, last))
        heapq.heappush(queue, (cost + 3, edits + "I", at, turn[last]))
        if at < len(signature):
            sign = signature[at]
            heapq.heappush(queue, (cost + 4, edits + "D", at + 1, last))
            if sign != "d":
                extra = 3 if sign.isupper() else 0
                heapq.heappush(queue, (cost + 3 + extra, edits + "R", at + 1, turn[last]))
                who = sign.lower()
                if who == turn[last] or (who == "s" and last == ""):
                    heapq.heappush(queue, (cost + extra, edits + "K", at + 1, who))


def path_of(signature):
    path = [END]
    for sign in reversed(signature):
        path.append(before(sign, path[-1]))
    return path


def test_audits_are_cheapest_and_least():
    rng = random.Random(1)
    for n in range(400):
        signature = "".join(rng.choice("duuaasxUASX") for _ in range(n % 12))
        path = path_of(signature)
        assert (path[-1][START][0], audit(signature, path)) == best_by_search(signature), signature


def test_ends_are_shared():
    import pyarrow as pa

    import tidemark.llm.conversations as module

    rng = random.Random(2)
    signatures = sorted("".join(rng.choice("uad") for _ in range(rng.randint(0, 9))) for _ in range(500))
    made, plain = [], module.before
    module.before = lambda sign, rest: made.append(sign) or plain(sign, rest)
    try:
        half = len(signatures) // 2
        batches = [pa.RecordBatch.from_arrays([pa.array(s, pa.string())], ["turned"]) for s in (signatures[:half], signatures[half:])]
        out = [r for b in _repairs(iter(batches)) for r in b.to_pylist()]
    finally:
        module.before = plain
    # One node for each end that is there, however many signatures have it.
    assert len(made) == len({s[:i] for s in signatures for i in range(1, len(s) + 1)})
    for turned, r in zip(signatures, out):
        assert (r["cost"], r["audit"]) == best_by_search(turned[::-1])


def plain_report(rows):
    """What `audits` and `repaired` say of one conversation, from (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, signs, faults, illegal = set(), "", [0, 0, 0], 0
    for i, (_, role, text) in enumerate(rows):
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = 1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        if fault:
            faults[fault - 1] += 1
        who = role[:1] if role[:1] in ("s", "u", "a") else "x"
        signs += "d" if fault in (1, 2) else who.upper() if fault else who
        illegal += i > 0 and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    cost, edits = best_by_search(signs)
    out, last, left = [], "", list(rows)
    for edit in edits:
        _, role, text = (None, None, "") if edit == "I" else left.pop(0)
        if edit == "D":
            continue
        role = role if edit == "K" else "assistant" if last == "u" else "user"
        last = role[:1]
        out.append((role, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out))
    return (gaps, *faults, illegal, cost, edits), out


def check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, _conv int, audit string")
    audited = audits(df)
    told = {r.conv_id: tuple(r)[1:] for r in audited.collect()}
    texts = {}
    for r in repaired(df, audited).collect():
        texts.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    groups = {}
    for conv, turn, role, text, *_ in rows:
        groups.setdefault(conv, []).append((turn, role, text))
    assert set(told) == set(groups)
    for conv, group in groups.items():
        report, out = plain_report(group)
        assert told[conv] == report, (conv, group)
        got = sorted(texts.get(conv, []))
        assert [p for p, _, _ in got] == list(range(len(got)))
        assert [(r, t) for _, r, t in got] == out


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(120)]:
        for _ in range(rng.randint(1, 14)):
            rows.append((
                conv,
                rng.choice([None, *range(12)]),
                rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "User", "", None]),
                rng.choice(["Hi.", "Yes!", "what?", "cut", "cut \n", "", " \t", None, "é.", "long " * 300 + "."]),
                1,
                "x",
            ))
    check(spark, rows)


def test_ties_repeats_and_hot_conversation(spark):
    rows = [(1, 0, "user", "Hi.", 0, ""), (1, 0, "user", "Hi.", 0, ""), (1, 0, "assistant", "Hi.", 0, "")]
    rows += [(2, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.", 0, "") for i in range(3000)]
    rows += [(3, -5, "user", "a", 0, ""), (3, 2**40, "assistant", "b.", 0, "")]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    audited = audits(df)
    assert audited.schema["conv_id"].dataType.simpleString() == "string"
    assert audited.count() == 0 and repaired(df, audited).count() == 0


def test_digest_is_that_of_the_repaired_rows(spark, tmp_path):
    from tidemark.llm.conversations import op12_suffix_shared_repair

    rows = [(0, 0, "user", "Hi."), (0, 1, "assistant", "Yes."), (9, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    got = {r.conv_id: r for r in op12_suffix_shared_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {0, 9}
    assert got[9].audit in ("", "D") and got[9].repaired_sha256 == hashlib.sha256(b"").hexdigest()
