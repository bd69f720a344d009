from cloudmarts.llm import preferences as f

SCHEMA = "pair_id long, turn long, role string, text string, prompt string, n_common int"


def side(spark, rows):
    return spark.createDataFrame([(*r, "mine", -1) for r in rows], SCHEMA)


def test_prefix_is_rendered_once_and_masks_train_answers(spark):
    chosen = side(spark, [(1, 0, "system", "S"), (1, 1, "user", "Q"), (1, 2, "assistant", "good é"), (1, 3, "user", "more"), (1, 4, "assistant", "ok")])
    rejected = side(spark, [(1, 0, "system", "S"), (1, 1, "user", "Q"), (1, 2, "assistant", "bad")])
    r = f.format_preferences(chosen, rejected).head()
    assert r["n_common"] == 2 and r["prompt"] == "<|system|>\nS<|end|>\n<|user|>\nQ<|end|>\n"
    assert r["chosen"].startswith("<|assistant|>\ngood é<|end|>\n<|user|>") and r["rejected"] == "<|assistant|>\nbad<|end|>\n"
    spans = [tuple(map(int, s.split(":"))) for s in r["chosen_mask"].split(",")]
    assert [r["chosen"][a:b] for a, b in spans] == ["good é<|end|>\n", "ok<|end|>\n"]
    a, b = map(int, r["rejected_mask"].split(":"))
    assert r["rejected"][a:b] == "bad<|end|>\n"


def test_edge_cases(spark):
    chosen = side(spark, [(1, 0, "user", "same"), (2, 0, None, None), (2, None, "user", "first"), (3, 0, "user", "only here"),
                          (5, 0, "user", "x"), (5, 0, "user", "x"), (None, 0, "user", "no pair")])
    rejected = side(spark, [(1, 0, "user", "same"), (2, 0, None, ""), (2, None, "user", "first"), (4, 0, "user", "only there"),
                            (5, 0, "user", "x")])
    out = {r["pair_id"]: r for r in f.format_preferences(chosen, rejected).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert out[1]["n_common"] == 1 and out[1]["chosen"] == out[1]["rejected"] == out[1]["chosen_mask"] == ""
    assert out[2]["prompt"] == "<|user|>\nfirst<|end|>\n<|unknown|>\n<|end|>\n"
    assert out[3]["rejected"] == "" and out[3]["n_common"] == 0 and out[4]["chosen"] == ""
    assert out[5]["n_common"] == 1 and out[5]["chosen"] == "<|user|>\nx<|end|>\n"
    assert f.format_preferences(chosen.limit(0), rejected.limit(0)).count() == 0


def test_swapped_answers(spark):
    talk = spark.createDataFrame([(0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"), (1, 0, "user", "q1"),
                                  (1, 1, "assistant", "a1"), (2, 0, "user", "alone"), (2, 1, "assistant", "a2"), (5, 0, "user", "no answer")],
                                 "conv_id long, turn int, role string, text string")
    out = {r["pair_id"]: r for r in f.format_preferences(*f.swapped_answers(talk)).collect()}
    assert out[0]["prompt"].endswith("q0<|end|>\n") and "a1" in out[0]["rejected"] and "bye" in out[0]["chosen"]
    assert out[2]["rejected"] == "" and out[5]["n_common"] == 1
    assert f.format_preferences(*f.swapped_answers(talk.limit(0))).count() == 0
