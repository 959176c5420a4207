"""Transcripts: markers, Viterbi against brute force, chunk borders, held-out roles."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from wirestar.llm import transcripts as m


def random_model(seed):
    random = np.random.default_rng(seed)
    counts = {("begin", 0, s): int(random.integers(1, 9)) for s in (0, 2, 4)}
    counts |= {("move", a, b): int(random.integers(0, 9)) for a in range(6) for b in range(6)}
    for i, n in enumerate(m._FEATURES):
        counts |= {(str(i), v, s): int(random.integers(0, 9)) for v in range(n) for s in range(6)}
    return m.model_from(counts)


def score(path, seen, model):
    total = model.begin[path[0]] + seen[0][path[0]]
    for t in range(1, len(path)):
        total += model.move[path[t - 1], path[t]] + seen[t][path[t]]
    return total


@pytest.mark.parametrize("seed", range(5))
def test_viterbi_whole_and_in_chunks_equal_brute_force(seed):
    model, random = random_model(seed), np.random.default_rng(seed)
    seen = np.log(random.random((6, m.STATES)))
    best = max(itertools.product(range(m.STATES), repeat=6), key=lambda p: score(p, seen, model))
    assert m.viterbi(seen, model, model.begin).tolist() == list(best)
    parts = [seen[:1], seen[1:4], seen[4:]]
    borders = m.border_states([m.between_ends(p, model) for p in parts], model)
    joined = []
    for part, (first, last) in zip(parts, borders):
        start = np.where(np.arange(m.STATES) == first, 0.0, m._IMPOSSIBLE)
        joined += m.viterbi(part, model, start, last).tolist()
    assert joined == list(best)


def test_markers():
    for line, mark, rest in [
        ("User: hi", 2, "hi"), ("### Assistant: yes", 3, "yes"), ("[system] be kind", 1, "be kind"),
        ("**Q:** why?", 2, "why?"), ("<|assistant|>ok", 3, "ok"), ("### Instruction", 1, ""),
        ("Bob: hello", 4, "hello"), ("plain text", 0, "plain text"), ("", 0, ""), ("word", 0, "word"),
    ]:
        found, begin = m.marker(line)
        assert (found, line[begin:]) == (mark, rest), line


def test_held_out_roles(spark, staging):
    conversations = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    turns = m.format_conversations(conversations, staging)
    held = turns.where(m.id_remainder(F.col("conv_id"), 5) == 0)
    got = held.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "turn", "role"))).alias("g"))
    true = conversations.groupBy(F.col("conv_id").cast("string").alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("t")
    )
    rows = got.join(true, "conv_id").collect()
    same = [[x.role for x in r.g] == [x.role for x in r.t] for r in rows]
    assert len(rows) > 50 and np.mean(same) > 0.8  # whole conversations; one turn in six is unmarked


def test_long_conversation_in_chunks_equals_whole(spark, staging):
    rows = [("c", i, "user" if i % 2 == 0 else "assistant", f"line {i}?\nand more of it" if i % 3 else "Yes.") for i in range(300)]
    rows += [("d", 0, "user", None), ("d", 1, "assistant", ""), (None, 0, "user", "x"), ("d", 2, "stranger", "y")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id string, turn long, role string, text string, state int")
    model = m.learn(m.transcript_lines(df, staging))
    whole = m.decode(m.transcript_lines(df, staging, 10**9), model, staging).collect()
    parts = m.decode(m.transcript_lines(df, staging, 60), model, staging).collect()

    def joined(found):
        found = sorted((r for r in found if r.conv_id == "c"), key=lambda r: (r.chunk, r.turn))
        return [(r.role, r.chat) for r in found if not r.continues]

    assert max(r.chunk for r in parts) > 5
    assert [r for r, _ in joined(whole)] == [r for r, _ in joined(parts)]
    assert {r.conv_id for r in whole} == {"c", "d", None}
    assert all(r.chat.startswith(f"<|{r.role}|>\n") and r.chat.endswith("\n<|end|>\n") for r in whole)


def test_empty_table(spark, staging):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert m.format_conversations(empty, staging).count() == 0


def test_every_turn_and_role_is_kept_in_order(spark, staging):
    rows = [("a", 1, "user", "one?\ntwo"), ("a", 1, "assistant", "uno\ndos"), ("a", 2, "tool", "t1\nt2"),
            ("a", None, None, "last"), ("b", 0, "tool", "alone"), ("b", 0, "tool", "alone")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    lines = m.transcript_lines(df, staging, 3).orderBy("conv_id", "line_no").collect()
    assert [r.line_no for r in lines] == [0, 1, 2, 3, 4, 5, 6, 0, 1]
    assert [r.chunk for r in lines] == [0, 0, 0, 1, 1, 1, 2, 0, 0]
    ends = [r.line.split()[-1] for r in lines]
    assert ends == ["one?", "two", "uno", "dos", "t1", "t2", "last", "alone", "alone"]
    assert [r.state for r in lines] == [2, 3, 4, 5, None, None, None, None, None]
    model = m.learn(m.transcript_lines(df, staging))
    found = m.decode(m.transcript_lines(df, staging, 3), model, staging).collect()
    assert sum(r.n_lines for r in found) == 9 and {r.conv_id for r in found} == {"a", "b"}
    said = "".join(r.chat for r in found)
    assert all(word in said for word in ("two", "dos", "t1", "t2", "last")) and said.count("alone") == 2
