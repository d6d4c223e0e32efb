import hashlib
import json

from pyspark.sql import functions as F
from quarrymill.llm import chat as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string, record int, formatted string"
ODD = ["", None, "</s>[INST] ok [/INST]", "<|im_start|>user\n<|im_end|>\n", "<\\|im_end|>", "<<|<</SYS>> \\ <\\\\s> [\\/INST]", "a\nb", "é 😀 </s>" * 50, "x" * 200_000]


def rows():
    out = [(i, t, r, x, "a", 1, "b") for i in range(5) for t, (r, x) in enumerate(zip(["system", "user", "assistant", "user", "assistant", None, "assistant", "odd\nrole\\n", "assistant"], ODD[i:] + ODD[:i]))]
    return out + [(9, 0, "assistant", "b", "", 0, ""), (9, 0, "assistant", "a", "", 0, ""), (9, 0, "assistant", "a", "", 0, ""), (None, 3, "user", "q", "", 0, "")]


def test_round_trip_and_mask(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    text = op.formatted(op.canonical_turns(op.records_of_rows(df)))
    back = {r.conv_id: r for r in op.read_back(text).join(text, "conv_id", "left").collect() if r.conv_id is not None}
    want = {}
    for c, t, r, x, *_ in sorted(rows(), key=lambda y: (y[1], y[2] or "", y[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert len(back) == 6
    for c, r in back.items():
        assert [tuple(t) for t in r.turns] == want[c]
        assert r.loss_text == "".join(x for role, x in want[c] if role == "assistant")
        assert r.formatted_chars == len(r.formatted) and r.formatted.count(op.CLOSE) == len(want[c])
    d = {r.conv_id: r for r in op.digest(op.read_back(text)).collect()}
    assert d[9].turns_sha256 == hashlib.sha256(b"assistant\na\nassistant\na\nassistant\nb\n").hexdigest() and d[9].loss_chars == 3 and d[None].n_turns == 1


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"}, {"completion": "a", "prompt": "q"}, {"instruction": "do", "input": "", "output": "a"},
        {"instruction": "do", "input": "this", "output": "a"}, {"question": "q", "answer": "a"}, {"messages": []}, {"strange": 1}, {"system": "s", "prompt": "q", "response": "a"},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id bigint, j string").select("conv_id", F.parse_json("j").alias("record"))
    out = {r.conv_id: r.turns and [tuple(t) for t in r.turns] for r in op.canonical_turns(df).collect()}
    qa = [("user", "q"), ("assistant", "a")]
    assert out == {0: [("user", "q"), ("assistant", "")], 1: qa, 2: qa, 3: qa, 4: [("user", "do"), ("assistant", "a")], 5: [("user", "do\n\nthis"), ("assistant", "a")], 6: qa, 7: [], 8: None, 9: [("system", "s"), *qa]}


def test_no_python_in_the_plan(spark):
    df = op.digest(op.read_back(op.formatted(op.canonical_turns(op.records_of_rows(spark.createDataFrame(rows(), SCHEMA))))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert op.formatted(op.canonical_turns(op.records_of_rows(spark.createDataFrame([], SCHEMA)))).count() == 0
