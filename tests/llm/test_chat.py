"""Chat windows: read back whole, within budget, each target once."""

import hashlib

import pytest

from thermocline.llm import chat


def expected(rows):
    rows = sorted(((t, r or "", x or "") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return [(r, x) for _, r, x in rows]


def rebuilt(windows):
    """Turns and targets per conversation, and the windows in order."""
    found = {}
    for w in sorted(chat.read_back(windows).collect(), key=lambda w: (w["part"], w["span"])):
        turns, targets, ws = found.setdefault(w["conv_id"], ([], [], []))
        turns += [tuple(t) for t in w["turns"]]
        targets += w["targets"]
        ws.append(w)
    return found


ODD = ["", None, "</s>", "<s>x[INST]y[/INST]</s>", "<\\s>[\\INST] <\\\\/s>", "<", "[", "\\", "<\\", "tail <", "[/INST]</s><s>", "$1 \\$ é😀", "\n\n"]


def test_control_strings_come_back(spark):
    frame = spark.createDataFrame([(1, k, role, x, 5) for k, (role, x) in enumerate((r, x) for x in ODD for r in ("user", "assistant", "<s>", None))], "conv_id long, turn long, role string, text string, span int")
    rows = [tuple(r)[1:4] for r in frame.collect()]
    for budget, history in ((2048, 256), (60, 20), (1, 0)):
        turns, targets, _ = rebuilt(chat.windows(frame, budget, history))[1]
        assert turns == expected(rows)
        assert targets == [x for r, x in expected(rows) if r == "assistant"]


@pytest.mark.parametrize("part_turns", [10_000, 7])
def test_windows_keep_their_budget_and_repeat_history(spark, monkeypatch, part_turns):
    monkeypatch.setattr(chat, "PART_TURNS", part_turns)
    budget, history = 60, 20
    rows = [(1, 0, "system", "Be good now")] + [(1, k, ("assistant", "user")[k % 2], "w " * (k * 7 % 23)) for k in range(1, 60)]
    rows += [(2, k, ("user", "assistant")[k % 2], "x " * (k % 5) if k != 4 else "long " * 300) for k in range(12)]
    rows += [(3, 0, "user", "no system"), (3, 1, "system", "a late one"), (3, 40, "assistant", "far"), (None, None, "user", None), (None, 2, "assistant", "tie"), (None, 2, "assistant", "tie")]
    found = rebuilt(chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget, history))
    tokens = lambda role, text: 4 + len(text.split()) + (1 if role else 0)
    for conv, (turns, targets, ws) in found.items():
        said = expected([r[1:] for r in rows if r[0] == conv])
        assert turns == said
        assert targets == [x for r, x in said if r == "assistant"]
        system = said[0] if said[0][0] == "system" else None
        done = 0
        for n, w in enumerate(ws):
            everything = [tuple(x.split("[INST]")) for x in w["formatted"].replace("<s>", "").split("[/INST]</s>")[:-1]]
            assert w["n_tokens"] == sum(tokens(*t) for t in everything)
            assert w["n_tokens"] <= budget or max(tokens(*t) for t in everything) > (budget - history - 9) // 2
            again = everything[: w["n_repeated"]]
            assert everything[w["n_repeated"] :] == said[done : done + len(w["turns"])]
            if n and system:
                assert again[0] == system
                again = again[1:]
            # history: the longest run of whole turns before the span within its tokens
            want, total = [], 0
            for t in reversed(said[1 if system else 0 : done]):
                total += tokens(*t)
                if total > history:
                    break
                want.insert(0, t)
            assert again == want or conv in (3, None)  # far turn numbers may stand behind a border
            done += len(w["turns"])
    assert len(found[1][2]) > 10


def test_query_reads_all_back(spark, sf):
    from thermocline.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, k, r, "</s>[INST] ok [/INST]") for k, r in enumerate(("user", "assistant"))]
    found = {r["conv_id"]: r for r in QUERIES["op13_chat"](spark, sf).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        said = expected([x[1:] for x in rows if x[0] == conv])
        loss = "".join(x for role, x in said if role == "assistant")
        assert r["n_turns"] == len(said) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_empty_and_long(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.windows(spark.createDataFrame([], schema)).count() == 0
    text = "<s>" * 100_000
    turns, targets, ws = rebuilt(chat.windows(spark.createDataFrame([(1, 0, "assistant", text)], schema)))[1]
    assert targets == [text] and turns == [("assistant", text)] and len(ws) == 1


def test_only_column_functions(spark, sf):
    from thermocline.llm.queries import QUERIES

    plan = QUERIES["op13_chat"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "MapIn"))
