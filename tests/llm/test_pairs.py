import pytest

from stepweave.llm import pairs
from stepweave.llm.language import asked_language, language_of

ASK = 'Goal: "lift the tiny red cup off the shelf"\nDescribe where the cup is in relation to the shelf.'


@pytest.mark.parametrize(
    "text, want",
    [
        (None, "empty"), ("", "empty"), (" \u200b ", "empty"), ("N/A", "empty"), ("...", "empty"), ("{}", "empty"), ("```json\n[]\n```", "empty"), ('[{"frame_index": 3, "task_reasoning": ""}]', "empty"), ('{"a": null}', "empty"),
        ("I'm sorry, but I can't help with that.", "refusal"), ("Request declined by policy.", "refusal"), ('[{"frame_index": 1, "task_reasoning": "I am not able to assist with this request."}]', "refusal"),
        ("I would rather not say. I'd rather not answer that.", "refusal"), ("As an AI, I am unable to describe people. I hope you understand.", "refusal"),
        ("I cannot see the back of the locker, but the free side looks wide enough.", None), ("Sorry for the long list: first align, then close, then lift.", None), ("Nothing in the scene refuses to move, so the plan stays short.", None),
        (ASK, "copy"), (ASK.upper(), "copy"), ("Question: describe where the cup is in relation to the shelf.", "copy"), ("Descirbe where the cup is in relation to the shelf", "copy"),
        ("You ask: Describe where the cup is in relation to the shelf. It stands to the left of it, close to the wall.", None),
        ("Der Arm muss sich langsam nähern, bevor der Greifer schließt.", "language"), ("Рука должна медленно подойти к предмету.", "language"), ("箱の上でグリッパーを開きます。", "language"),
        ('[{"frame_index": 0, "task_reasoning": "Il braccio deve avvicinarsi lentamente prima di chiudere la pinza."}]', "language"),
        ('[{"frame_index": 0, "task_reasoning": "The cup is on the', "truncated"), ('```json\n[{"frame_index": 0, "a": "The cup."}, {"frame\n```', "truncated"),
        ('Here it is:\n[{"frame_index": 0, "a": "The cup is red."}]', None), ("4", None), ("Left.", None), ("yes", None), ('{"answer": 4}', None), ("[4]", None),
    ],
)
def test_rules(text, want):
    assert pairs.judge(text, ASK)[0] == want


def test_asked_languages():
    asked = ASK + " Please reply in Spanish only."
    spanish, portuguese = "El brazo debe acercarse despacio al objeto antes de cerrar la pinza.", "A garra abre quando o objeto está por cima da caixa."
    assert pairs.judge(spanish, asked)[0] is None and pairs.judge(portuguese, asked)[0] == "language"
    assert pairs.judge("The arm has to come closer to the cup.", asked)[0] == "language"
    assert asked_language("Write your answer in Japanese.") == "ja" and asked_language("The answer is in the box.") is None
    assert language_of("4") is None and language_of("Es steht nichts im Weg.") == "de" and language_of("Rien ne gêne le passage.") == "fr"


def _tables(spark, answers, ask=ASK):
    results = spark.createDataFrame([(i, 1, t, "m", (1, 5, 6)) for i, t in enumerate(answers)], "result_id long, prompt_id long, text string, model string, usage struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>")
    return results, spark.createDataFrame([(1, ask), (1, ask), (2, None)], "prompt_id long, text string")


def test_truncation_by_all_answers(spark):
    whole = [f"The {o} stands left of the hand. The wrist turns so that the handle points at the {o}." for o in ("cup", "jar", "pan", "lid", "pot", "mug")]
    whole += ["Nothing stands in the way of it.", "Because it is glass, a light grip is enough."]
    cut = ["The cup stands left of the", "The jar stands left of the hand. The wri", "The pan stands left of the hand. No", "Because it is glass, a light gr", "The lid stands left of the hand; it moves and"]
    fine = ["The pot stands left of the hand", "The wrist turns so that the handle points at the mug"]
    results, prompts = _tables(spark, whole + cut + fine)
    got = {r.result_id: r.defect for r in pairs.broken_pairs(results, prompts).collect()}
    assert got == {len(whole) + i: "truncated" for i in range(len(cut))}


def test_edges(spark):
    results, prompts = _tables(spark, ["", None, "word " * 60_000 + "end."])
    more = results.union(results).unionByName(spark.sql("select null as result_id, 1L as prompt_id, '' as text, null as model, null as usage")).unionByName(
        spark.sql("select 90L as result_id, null as prompt_id, '' as text, null as model, null as usage union all select 91L, 77L, 'Fine it is.', 'm', null union all select 92L, 2L, 'So it is.', 'm', null")
    )
    extra = more.selectExpr("*", "1 as defect", "2 as tail", "3 as prompt", "4 as n")
    got = sorted((r.result_id, r.defect) for r in pairs.broken_pairs(extra, prompts).collect())
    assert got == [(0, "empty"), (1, "empty"), (90, "empty")]
    assert pairs.broken_pairs(results.limit(0), prompts).count() == 0
    assert pairs.broken_pairs(results, prompts.limit(0)).count() == 2


def test_whole_answers_and_json_values_are_compared(spark):
    whole = ["The cup is red. The lid is blue. The pan is wide enough for both.", '[{"task_reasoning": "The cup has to go up first.", "move_reasoning": "The arm moves left because it must pass the lid."}]']
    cut = ["The cup is red. The lid is", '[{"task_reasoning": "The cup has to go up first.", "move_reasoning": "The arm moves left because it"}]']
    fine = ['[{"task_reasoning": "The cup has to go up first.", "move": "left"}]', '[{"move": "move left now then", "move_reasoning": "go on to the left side"}]']
    results, prompts = _tables(spark, whole + cut + fine)
    assert {r.result_id: r.defect for r in pairs.broken_pairs(results, prompts).collect()} == {2: "truncated", 3: "truncated"}


def test_hot_tails(spark):
    """A third of all answers are one broken one; spreading them changes nothing."""
    answers = [f"The {o} stands left of the hand." for o in ("cup", "jar", "pan", "lid")] * 10 + ["The cup stands left of the"] * 20
    results, prompts = _tables(spark, answers)
    assert {r.result_id for r in pairs.broken_pairs(results, prompts).collect()} == set(range(40, 60))


# Refusals in wordings that were written after the patterns.
UNLIKE_REFUSALS = """
I'd sooner not get into that.
My apologies, but that is off limits.
I must pass.
No comment.
Regretfully, this isn't a request I'm allowed to take on.
I have been told not to talk about such pictures.
Please direct this to somebody else, I won't answer it.
That's not something I do.
I'm going to sit this one out.
Our guidelines don't allow me to go there.
This conversation cannot continue; I refuse to describe people.
Sorry, no can do.
My programming stops me from answering.
We are unable to fulfil your request at this time.
I don't think it would be right to answer this.
I respectfully decline.
You will have to ask someone else.
I'm not the right one to answer this, so I'll leave it there.
The response was blocked by the safety filter.
I would prefer not to give an opinion.
Dabei kann ich dir leider nicht weiterhelfen.
Das möchte ich lieber nicht beantworten.
Je suis désolé, mais je ne peux pas répondre à cette question.
Je préfère ne pas m'exprimer là-dessus.
Lo siento, no puedo ayudar con esta solicitud.
Prefiero no contestar.
Mi dispiace, non posso rispondere a questa domanda.
Desculpe, mas não posso ajudar com isso.
Извините, но я не могу ответить на этот вопрос.
申し訳ありませんが、お答えできません。
抱歉，我无法回答这个问题。
""".strip().splitlines()
NO_REFUSALS = """
The arm cannot help but collide, so we can't continue on the left path; it moves right around the cup.
We do not give the arm force here. It lifts the cup.
The gripper cannot reach the handle because the jar is in the way.
I can't tell whether the lid is closed, but the free side is wide enough.
We must refrain from touching the rim, so the hand goes in from above.
The drawer refuses to open, so the arm pulls harder.
It is not possible to go straight; the arm turns first.
Unfortunately the cup is behind the box, so the arm goes around it.
I am not able to see the back of the box. The front is free.
We will not move the cup before the lid is off.
The plan does not allow for a second grasp.
Sorry for the long answer: first align, then close.
As the box blocks the path, the arm has to rise.
Nothing prevents the hand from closing.
We should not lift it by the rim.
""".strip().splitlines()


def test_refusals_in_other_words():
    found = [t for t in UNLIKE_REFUSALS if pairs.judge(t, ASK)[0] == "refusal"]
    assert len(found) >= 0.9 * len(UNLIKE_REFUSALS), set(UNLIKE_REFUSALS) - set(found)
    assert [t for t in NO_REFUSALS if pairs.judge(t, ASK)[0] == "refusal"] == []


def test_long_copies_are_judged_fast():
    import time

    text = " ".join(f"word{i % 700} of" for i in range(6000))
    began = time.time()
    assert pairs.judge(text, text)[0] == "copy" and time.time() - began < 20
