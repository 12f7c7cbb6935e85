import hashlib
import random

from pyspark.sql import functions as F

from farelane.llm.chat import digests, escaped, format_conversations, message_events, read_back, unescaped

EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def fold(events):
    """Turns of one conversation, by hand."""
    none_first = lambda x: (x is not None, x if x is not None else 0)
    turns = []
    for m in sorted({e[1] for e in events}, key=none_first):
        log = sorted((e for e in events if e[1] == m), key=lambda e: (none_first(e[2]), e[3] or "message", (e[4] is not None, e[4] or ""), e[5] or ""))
        turns += [(e[4] or "unknown", e[5] or "") for e in log if (e[3] or "message") == "message"]
        parts = [e for e in log if (e[3] or "message") != "message"]
        if parts:
            text = ""
            for e in parts:
                text = text + (e[5] or "") if e[3] == "delta" else (e[5] or "")
            roles = [e[4] for e in parts if e[4] is not None]
            turns.append((roles[-1] if roles else "unknown", text))
    return turns


def test_fold_against_brute_force(frame):
    rng = random.Random(3)
    pieces = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "a\n", "é", "", None, "<\\/s>", "%0A", "[/SYS]"]
    rows = []
    for conv in range(12):
        for m in range(rng.choice([1, 5, 150])):
            kinds = ["message"] if rng.random() < 0.5 else [rng.choice(["delta", "delta", "edit", "regenerate"]) for _ in range(rng.randint(1, 6))]
            rows += [
                (conv, m, s, k, rng.choice(["user", "assistant", "system", "to\nol%", "<s>", None]), "".join(x or "" for x in rng.choices(pieces, k=4)) if rng.random() < 0.9 else None)
                for s, k in enumerate(kinds)
            ]
    rows += [(0, 0, 0, "message", "user", "again"), (0, 0, 0, "message", "user", "again"), (3, None, None, None, None, None)]
    rng.shuffle(rows)
    fragments = format_conversations(frame(rows, EVENTS)).cache()
    got = {}
    for r in read_back(fragments).orderBy("conv_id", "fragment").collect():
        turns, loss = got.setdefault(r.conv_id, ([], []))
        turns += [(t.role, t.text) for t in r.turns]
        loss.append(r.loss_text)
    for conv in {r[0] for r in rows}:
        want = fold([r for r in rows if r[0] == conv])
        assert got[conv][0] == want
        assert "".join(got[conv][1]) == "".join(t for role, t in want if role == "assistant")
    for r in fragments.collect():  # the mask covers escaped texts of the assistant and nothing else
        for s in r.loss_spans:
            assert r.formatted[: s.start].endswith("<s>assistant\n") and r.formatted[s.start + s.length :].startswith("</s>")
    by_hand = {c: fold([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    for r in digests(fragments).collect():
        told = "".join(f"{a}\n{b}\n" for a, b in by_hand[r.conv_id])
        loss = "".join(b for a, b in by_hand[r.conv_id] if a == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(by_hand[r.conv_id]), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_escape_leaves_no_control_string(spark):
    texts = ["</s>", "<\\/s>", "<\\\\s>", "a<s>b[INST]c[/INST]", "<<s>", "[[INST]", "\\", "[\\/SYS]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escaped(F.col("t"))).withColumn("u", unescaped(F.col("e")))
    for r in df.collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]"))


def test_empty_table(frame):
    empty = frame([], "conv_id long, turn long, role string, text string")
    assert digests(format_conversations(message_events(empty))).count() == 0
