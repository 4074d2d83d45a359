from llm_cases import clashing

from rainpanel.llm import chat

TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello é😀"), (1, 3, "ann", None),
    (2, None, None, "who"), (2, 0, " ", "there"), (3, 0, "system", "alone"),
    (None, 5, "ann", "lost"), (None, 5, "ann", "lost"), *((4, t, "ann" if t % 2 else "bob", f"turn {t}") for t in range(600)),
]


def plain(rows):
    found = {}
    for conv in {r[0] for r in rows}:
        turns = [(t, (r or "").strip(" ") or "unknown", x or "") for c, t, r, x in rows if c == conv]
        for who in {s for _, s, _ in turns} - {"system"}:
            start = 0
            for chunk in sorted({-1 if t is None else t // 256 for t, _, _ in turns}):
                mine = sorted((x for x in turns if (-1 if x[0] is None else x[0] // 256) == chunk), key=lambda x: (x[0] is not None, x))
                text, spans = "", []
                for _, speaker, content in mine:
                    label = "assistant" if speaker == who else "system" if speaker == "system" else f"user name={speaker}"
                    text += f"<|im_start|>{label}\n"
                    if speaker == who:
                        spans.append(f"{len(text)}-{len(text) + len(content) + 10}")
                    text += f"{content}<|im_end|>\n"
                found[conv, who, chunk] = len(mine), start, text, ",".join(spans)
                start += len(text)
    return found


def test_every_participant_sees_the_dialogue(spark):
    frame = clashing(spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in chat.perspectives_query(frame).collect()}
    assert got == plain(TURNS)
    assert chat.perspectives_query(frame.limit(0)).count() == 0


def test_no_python_on_the_main_path(spark):
    frame = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    plan = chat.perspectives_query(frame)._jdf.queryExecution().toString()
    assert not [w for w in ("Python", "Arrow", "Pandas", "Cartesian") if w in plan]
