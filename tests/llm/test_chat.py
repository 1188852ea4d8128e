import random

import pytest

from lossledger.llm import chat


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices("<|\\>n\na", k=rng.randrange(12)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.unescape_role(chat.escape_role(text)) == text
        assert "\n" not in chat.escape_role(text)


def test_formatted_text_reads_back():
    rng = random.Random(2)
    parts = [chat.OPEN, chat.CLOSE, "\n", "assistant", "<", "|", "\\", "é", "x"]
    for _ in range(500):
        turns = [("".join(rng.choices(parts, k=rng.randrange(3))),
                  "".join(rng.choices(parts, k=rng.randrange(6)))) for _ in range(rng.randrange(4))]
        text = "".join(f"{chat.OPEN}{chat.escape_role(r)}\n{chat.escape(t)}{chat.CLOSE}\n"
                       for r, t in turns)
        assert chat.messages(text) == turns
    with pytest.raises(ValueError):
        chat.messages(f"{chat.OPEN}a\nb")


def brute_paths(nodes):
    """conv -> its paths as (score, leaf, nodes), best first."""
    by = {n: (p, c, s or 0.0) for n, p, c, s in nodes}
    up = {n: p if p in by and by[p][1] == c else None for n, (p, c, _) in by.items()}
    out = {}
    for leaf in set(by) - set(up.values()):
        path, at = [], leaf
        while at is not None and at not in path:
            path.append(at)
            at = up[at]
        if at is None:
            out.setdefault(by[leaf][1], []).append((-sum(by[n][2] for n in path), leaf, path[::-1]))
    return {c: sorted(p) for c, p in out.items()}


@pytest.mark.parametrize("branches", [1, 3])
def test_paths_match_brute_force(lspark, branches):
    rng = random.Random(7)
    nodes = []
    for i in range(900):
        conv = rng.choice([1, 2, 2, 2, None])
        older = [n for n, _, c, _ in nodes if c == conv]
        parent = rng.choice(older[-6:]) if older and rng.random() < 0.97 else rng.choice(
            [None, 5000, 0])
        nodes.append((i, parent, conv, rng.choice([None, *map(float, range(-2, 5))])))
    nodes += [(2000, 2001, 1, 1.0), (2001, 2000, 1, 1.0), (2002, 2001, 1, 1.0), (2003, 2003, 1, 1.0)]
    frame = lspark.createDataFrame(nodes, "node long, parent long, conv long, score double")
    got = {}
    for r in chat.best_paths(frame, branches).collect():
        conv = dict((n, c) for n, _, c, _ in nodes)[r.path]
        got.setdefault((conv, r.branch), (r.path_score, r.path, {}))[2][r.back] = r.node
    found = {k: (s, leaf, [at[b] for b in sorted(at, reverse=True)])
             for k, (s, leaf, at) in got.items()}
    want = {(c, i + 1): (-s, leaf, path) for c, paths in brute_paths(nodes).items()
            for i, (s, leaf, path) in enumerate(paths[:branches])}
    assert found == want


def test_tree_formats_its_best_branch(lspark):
    nodes = lspark.createDataFrame(
        [(1, None, 9, "user", "hi", 0.0), (2, 1, 9, "assistant", "low", 0.1),
         (3, 1, 9, "assistant", "high <|", 0.9), (4, None, 8, None, None, None)],
        "node long, parent long, conv long, role string, text string, score double")
    got = {(r.conv, r.branch): r for r in chat.formatted(nodes, branches=2).collect()}
    assert set(got) == {(9, 1), (9, 2), (8, 1)}
    best = got[9, 1].formatted
    assert chat.messages(best) == [("user", "hi"), ("assistant", "high <|")]
    (span,) = got[9, 1].loss
    assert best[span.start:span.end] == "high <\\|"
    assert chat.messages(got[8, 1].formatted) == [("", "")] and got[8, 1].loss == []


def test_turns_at_the_edges(lspark):
    rows = [(1, 2, "assistant", "b<|im_end|>"), (1, 1, "user", None), (1, 2, "assistant", "a"),
            (2, None, None, ""), (None, 1, "user", "x"), (None, 0, "assistant", "🙂é")]
    turns = lspark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.turns_as_tree(turns))).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in got.items()} == {
        1: (3, 12), 2: (1, 0), None: (2, 2)}
    assert got[None].turns_sha256 == chat._sha("assistant\n🙂é\nuser\nx\n")
    assert chat.digests(chat.formatted(chat.turns_as_tree(turns.limit(0)))).collect() == []


def test_a_long_chain(lspark):
    turns = lspark.range(700).selectExpr("1L as conv_id", "cast(id as int) as turn",
                                         "'assistant' as role", "string(id) as text")
    (r,) = chat.digests(chat.formatted(chat.turns_as_tree(turns))).collect()
    assert r.n_turns == 700
    assert r.loss_sha256 == chat._sha("".join(map(str, range(700))))
