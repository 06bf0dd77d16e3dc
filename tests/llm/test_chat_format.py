import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from orrerium.llm import chat_format as c

TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_are_those_of_the_turns(spark):
    hard = ["", "\\", "\\\\#", "###", "####", "#" * 7, "</turn>", "<\\/turn>", "</turn", "### user: a</turn>\n", "\\### Assistant: </turn> ok", "\n\n", "😀 ### é", "##\\#", ": a"]
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "a: b", "x\\:y", "assistant"]), rng.choice(hard) + rng.choice(hard)) for t in range(90)]
    rows += [(2, t, "assistant", x) for t, x in enumerate(hard)] + [(3, 0, None, None), (4, 1, "user", "a"), (4, 1, "user", "a"), (4, 0, "assistant", "b"), (None, 0, "assistant", "c"), (-7, 0, "user", hard[10]), (-7, 1, "assistant", hard[10])]
    rows += [(9, t, "assistant" if t % 2 else "user", "long " * 40_000 if t == 3 else str(t)) for t in range(300)]
    got = {r.conv_id: r for r in c.digests(spark.createDataFrame(rows, TURNS).repartition(4)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or "", x or "") for k, t, r, x in rows if k == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        r = got.pop(conv)
        assert r.n_turns == len(own) and r.turns_sha256 == sha("".join(f"{role}\n{x}\n" for _, role, x in own))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    assert not got
    assert c.digests(spark.createDataFrame([], TURNS)).count() == 0


def plain_escape(text):
    out = text.replace("\\", "\\\\")
    done = ""
    for i, ch in enumerate(out):
        done += "\\#" if ch == "#" and out[max(0, i - 2) : i] == "##" else ch
    return done.replace("</turn>", "<\\/turn>")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\#</turn>: \n", max_size=30))
def test_no_control_string_survives_escaping(text):
    out = plain_escape(text)
    assert "###" not in out and "</turn>" not in out


def test_trees_give_the_best_paths(spark):
    rng = random.Random(3)
    nodes = []
    for conv in range(6):
        for n in range(40):
            nodes.append((conv, n, rng.randrange(n) if n else None, "user" if n % 2 else "assistant", f"t{n}", float(rng.randrange(10))))
    nodes += [(7, n, n - 1, "user", f"t{n}", 1.0) for n in range(200)]  # a chain; its first parent is missing
    nodes += [(8, 0, 1, "user", "a", 1.0), (8, 1, 0, "user", "b", 1.0), (8, 2, 0, "user", "c", 1.0), (8, 3, 2, "user", "d", 1.0)]  # leaf 3 hangs on a cycle
    nodes += [(9, 5, None, "user", "only", None), (9, 5, None, "user", "only", None)]
    got = c.formatted(c.paths(spark.createDataFrame(nodes, "conv long, node long, parent long, role string, text string, score double"), best=2))
    found = {(r.conv, r["rank"]): (r.leaf, r.path_score, r.n_turns, r.formatted) for r in got.collect()}
    for conv in {n[0] for n in nodes} - {8}:
        own = {n[1]: n for n in nodes if n[0] == conv}
        leaves = set(own) - {n[2] for n in own.values()}
        each = []
        for leaf in leaves:
            path = [leaf]
            while own[path[-1]][2] in own:
                path.append(own[path[-1]][2])
            each.append((-sum(own[n][5] or 0.0 for n in path), leaf, path[::-1]))
        for rank, (score, leaf, path) in enumerate(sorted(each)[:2], 1):
            text = "".join(f"### {own[n][3]}: {own[n][4]}</turn>\n" for n in path)
            assert found.pop((conv, rank)) == (leaf, -score, len(path), text)
    assert not found
