"""Formatting against a direct rendering of whole conversations, and exact round trips."""

import hashlib
import random

import pytest

from silverlode.llm import chat

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[\\INST]", "<\\\\/s>", "[", "<", "\\", " ", "\n", "x", "é"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn, role is not None, role or "", text is not None, text or ""))
    out = []
    for conv, own in groups.items():
        turns = [(r, t) for _, _, _, r, _, t in sorted(own)]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = chat.INSTRUCT.render(turns)
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(whole)))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, chat.digests(df).collect()), key=str) == brute(rows)


def test_escaping_is_reversible_and_leaves_no_control_string():
    pick = random.Random(1)
    for _ in range(3000):
        text = "".join(pick.choices(CONTROLS, k=pick.randint(0, 8)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in CONTROLS[:6])


def test_outputs_are_read_back():
    pick = random.Random(2)
    for _ in range(500):
        turns = [
            (pick.choice(["user", "assistant", "system", "", "[/ROLE]"]), "".join(pick.choices(CONTROLS, k=pick.randint(0, 6))))
            for _ in range(pick.randint(0, 6))
        ]
        assert chat.INSTRUCT.read(chat.INSTRUCT.render(turns)) == turns


def test_fixture(spark, sf_small):
    rows = chat.with_control_strings(spark.read.parquet(f"{sf_small}/conversations.parquet"))
    check(spark, [tuple(r) for r in rows.collect()])


def test_odd_conversations(spark):
    pick = random.Random(3)
    rows = [(1, None, None, None), (1, 0, "user", None), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, 1, "user", "u")]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (None, 2, "tool", "")]
    rows += [(5, i, pick.choice(["user", "assistant"]), "".join(pick.choices(CONTROLS, k=5))) for i in range(700)]
    rows += [(6, 0, "assistant", "long " * 200_000 + "</s>")]
    check(spark, rows)


def test_spans_make_up_the_output():
    turns = [(("user", "assistant")[i % 2], f"turn {i} [INST]") for i in range(40)]
    found = list(chat.spans(turns, chat.INSTRUCT.render, context=4))
    assert "".join(s.piece for s in found) == chat.INSTRUCT.render(turns)
    for (_, text), span in zip(turns, found, strict=True):
        assert chat.unescape(span.piece[span.start : span.stop]) == text


def thoughts_dropper():
    """A template that shows only the last assistant's thoughts; made here so that workers get it by value."""

    def drop_thoughts(turns):
        last = max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=None)
        return "".join(f"{r}:{t if i == last or r != 'assistant' else t.split('|')[-1]};" for i, (r, t) in enumerate(turns))

    return drop_thoughts


def shout_first(turns):
    return "".join(f"{t.upper() if i == 0 else t};" for i, (_, t) in enumerate(turns))


def test_rewritten_history_is_detected(spark):
    drop_thoughts = thoughts_dropper()
    turns = [("user", "q"), ("assistant", "hm|a"), ("user", "q2"), ("assistant", "hm|b"), ("user", "q3")]
    found = [s.rewritten for s in chat.spans(turns, drop_thoughts)]
    assert found == [False, False, False, True, False]
    assert not any(s.rewritten for s in chat.spans(turns, shout_first, context=1))
    assert [s.rewritten for s in chat.spans(turns, drop_thoughts, context=0)] == found
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    template = chat.Template(drop_thoughts, lambda s: [], lambda s: s)
    rows = chat.formatted(df, template).orderBy("turn").collect()
    assert [r.rewritten for r in rows] == found
    assert rows[3].piece is None and not rows[3].has_loss
    with pytest.raises(Exception, match="rewrites history"):
        chat.digests(df, template).collect()


def test_formatted_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b</s>")], "conv_id long, turn int, role string, text string")
    rows = chat.formatted(df).orderBy("turn").collect()
    assert [r.has_loss for r in rows] == [False, True]
    assert rows[1].piece[rows[1].text_start : rows[1].text_stop] == "b<\\/s>"


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(empty).count() == 0
    assert chat.digests(chat.with_control_strings(empty)).count() == 1
    clash = spark.createDataFrame([(1, 0, "user", "a", 9, "p")], "conv_id long, turn long, role string, text string, n_turns int, piece string")
    assert chat.digests(clash).first().n_turns == 1


def test_a_rewrite_of_turn_2_at_turn_15_is_detected(spark):
    turns = [("user", "q"), ("assistant", "hm|a"), *[("tool", f"r{i}") for i in range(12)], ("user", "q2"), ("user", "q3")]

    def strip_before_last_user(turns):
        last = max((i for i, t in enumerate(turns) if t[0] == "user"), default=-1)
        return "".join(f"{r}:{t.split('|')[-1] if i < last else t};" for i, (r, t) in enumerate(turns))

    want = [i == 14 for i in range(16)]
    assert [s.rewritten for s in chat.spans(turns, strip_before_last_user)] == want
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    rows = chat.formatted(df, chat.Template(strip_before_last_user, lambda s: [], lambda s: s)).orderBy("turn").collect()
    assert [r.rewritten for r in rows] == want


def test_templates_may_number_turns_and_insist_on_alternation():
    def numbered(turns):
        assert all(a[0] != b[0] for a, b in zip(turns, turns[1:], strict=False))
        return "".join(f"{i}. {t}\n" for i, (_, t) in enumerate(turns, 1))

    turns = [(("user", "assistant")[i % 2], f"text {i}") for i in range(30)]
    found = list(chat.spans(turns, numbered))
    assert [s.piece for s in found] == [f"{i}. text {i - 1}\n" for i in range(1, 31)]
    assert [s.piece[s.start : s.stop] for s in found] == [t for _, t in turns]


def test_the_context_of_the_registered_template_changes_nothing():
    pick = random.Random(4)
    turns = [(pick.choice(["user", "assistant", "tool"]), "".join(pick.choices(CONTROLS, k=4))) for _ in range(60)]
    whole = list(chat.spans(turns, chat.INSTRUCT.render))
    assert list(chat.spans(turns, chat.INSTRUCT.render, chat.INSTRUCT.context)) == whole


@pytest.mark.parametrize("turns", [10, 33, 100])
def test_a_template_that_lies_about_its_context_is_caught(spark, turns):
    """It upper-cases turn 2 once there are six turns."""

    def lying(said):
        return "".join(f"{t.upper() if i == 1 and len(said) > 5 else t};" for i, (_, t) in enumerate(said))

    own = [("user", f"text {i}") for i in range(turns)]
    assert [s.rewritten for s in chat.spans(own, lying, context=0)] == [i == 5 for i in range(turns)]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(own)], "conv_id long, turn long, role string, text string")
    with pytest.raises(Exception, match="rewrites history"):
        chat.digests(df, chat.Template(lying, lambda s: [], lambda s: s, context=0)).collect()


def test_long_conversations_are_rendered_once_where_the_context_holds():
    calls = []

    def counted(said):
        calls.append(len(said))
        return chat.INSTRUCT.render(said)

    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(200)]
    found = list(chat.spans(turns, counted, context=0))
    assert "".join(s.piece for s in found) == chat.INSTRUCT.render(turns) and sum(calls) < 7 * len(turns)
    calls.clear()
    list(chat.spans(turns[:8], counted, context=0))
    assert max(calls) == 8 and sorted(set(calls)) == list(range(9))


@pytest.mark.parametrize("turns", [12, 32, 33, 100])
def test_a_rewrite_taken_back_later_is_seen_in_conversations_of_any_length(spark, turns):
    """It upper-cases turn 2 while there are exactly 11 turns."""

    def once(said):
        return "".join(f"{t.upper() if i == 1 and len(said) == 11 else t};" for i, (_, t) in enumerate(said))

    own = [("user", f"text {i}") for i in range(turns)]
    want = [i in (10, 11) for i in range(turns)]
    assert [s.rewritten for s in chat.spans(own, once)] == want
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(own)], "conv_id long, turn long, role string, text string")
    rows = chat.formatted(df, chat.Template(once, lambda s: [], lambda s: s)).orderBy("turn").collect()
    assert [r.rewritten for r in rows] == want
    assert chat.INSTRUCT.context is None  # so this holds for the registered query


@pytest.mark.parametrize("turns", [9, 16, 17, 32, 33, 64, 65, 200])
def test_a_promised_context_is_checked_by_one_rule_for_any_length(turns):
    """Pieces are found from the context for short conversations too, and the same prefixes are checked."""
    calls = []

    def counted(said):
        calls.append(len(said))
        return chat.INSTRUCT.render(said)

    own = [(("user", "assistant")[i % 2], f"t{i}") for i in range(turns)]
    assert list(chat.spans(own, counted, context=0)) == list(chat.spans(own, chat.INSTRUCT.render))
    assert set(calls) == {*range(9), *[n for n in (16, 32, 64, 128) if n < turns], turns}
