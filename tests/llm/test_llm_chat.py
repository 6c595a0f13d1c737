from collections import defaultdict

from syncledger.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pos long, start long, masks string, none boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", True) for r in rows], SCHEMA)


def low(x):
    return (x is not None, x)


def plain(rows):
    """(whole rendering, masked places) by dialogue and assistant."""
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role, text))
    out = {}
    for conv, messages in by_conv.items():
        messages.sort(key=lambda m: tuple(map(low, m)))
        for who in {m[1] for m in messages} - {None, "system"}:
            whole, masks = "", []
            for _, role, text in messages:
                head = "assistant" if role == who else "system" if role == "system" else \
                    "user" if role is None else f"user name={role}"
                whole += f"<|im_start|>{head}\n"
                if role == who:
                    masks.append((len(whole), len(whole) + len(text or "") + len("<|im_end|>")))
                whole += (text or "") + "<|im_end|>\n"
            out[conv, who] = whole, masks
    return out


def joined(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["conv_id"], r["assistant"]].append(r)
    whole = {}
    for key, chunks in out.items():
        chunks.sort(key=lambda r: r["chunk"])
        text = ""
        for r in chunks:
            assert r["start"] == len(text)
            text += r["text"]
        whole[key] = text, [(m["start"], m["end"]) for r in chunks for m in r["masks"]]
    return whole


ROWS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hé 🙂"), (1, 2, "bob", "hello\nyou"), (1, 3, "cy", ""), (1, 4, "ann", None),
        (1, 4, "ann", None), (1, 4, "ann", "tie"), (1, None, "bob", "first"), (2, 0, "system", "alone"), (3, 0, None, "who?"),
        (3, 1, "bob", "me"), (None, 0, "ann", "lost"), (None, 1, "bob", "found"), (0, 0, "ann", "zero"), (4, 0, "user", "x" * 200_000)]


def test_renderings_equal_brute_force(spark):
    assert joined(chat.rotate(table(spark, ROWS))) == plain(ROWS)


def test_a_long_dialogue_in_chunks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(chat, "GROUP", 3)
    rows = [(7, i, ["ann", "bob", "cy"][i * i % 3], f"m{i}" * (i % 5)) for i in range(300)] + ROWS
    out = chat.rotate(table(spark, rows), chunk=8)
    assert max(r["n_messages"] for r in out.collect()) == 8
    assert joined(out) == plain(rows)


def test_masks_cover_what_the_assistant_says(spark):
    text, masks = joined(chat.rotate(table(spark, ROWS)))[1, "bob"]
    assert [text[a:b] for a, b in masks] == ["first<|im_end|>", "hello\nyou<|im_end|>"]


def test_empty_table(spark):
    assert chat.rotate(table(spark, [])).count() == 0
