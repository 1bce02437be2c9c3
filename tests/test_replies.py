import math

import pytest

from docsheaf import constants as C
from docsheaf.functions.replies import parse_replies

G = (
    '{"summary":"S.","entities":{"people":["A","B"],"places":[],"organizations":["O"]},'
    '"sentiment":{"label":"positive","confidence":0.9},"key_questions":["q1","q2","q3"]}'
)
PAD = C.QUESTION_PAD


def g(old, new):
    assert old in G
    return G.replace(old, new)


FULL = dict(parse_path="strict", summary="S.", people=["A", "B"], places=[], orgs=["O"],
            label="positive", confidence=0.9, questions=["q1", "q2", "q3"], parse_error=None, reason=None)
FELL = dict(parse_path="fallback", summary=C.FALLBACK_SUMMARY, people=[], places=[], orgs=[], label="neutral",
            confidence=0.0, questions=[C.FALLBACK_QUESTION] * 3, parse_error=True, reason=None)
EMPTY = dict(parse_path="strict", summary=C.DEFAULT_SUMMARY, people=[], places=[], orgs=[], label="neutral",
             confidence=0.5, questions=[PAD] * 3, parse_error=None, reason=None)


def bad(reason):
    return dict.fromkeys(FULL) | dict(parse_path="failed", reason=reason)


TYPE = "entity list has a wrong type"
CASES = {
    "plain": (G, FULL),
    "fence": (f"```json\n{G}\n```", FULL),
    "bare fence": (f"```{G}```", FULL),
    "upper fence": (f"```JSON\n{G}\n```", FULL),
    "prose": (f"Here: {G}\nBye.", FULL),
    "trailing comma": (g('"q3"]', '"q3", ]'), FULL | dict(parse_path="repaired")),
    "comma and nan": (g("0.9}", "NaN,}"), FULL | dict(parse_path="repaired", confidence=1.0)),
    "cut off": ('{"summary": "Cut off", "sentiment": {"label": "Negative", "conf',
                FELL | dict(summary="Cut off", label="negative")),
    "refusal": ("I cannot help.", FELL),
    "blank": (" \n ", bad("empty reply")),
    "empty": ("", bad("empty reply")),
    "no reply": (None, bad(None)),
    "list": ("[]", bad("reply is not an object")),
    "string": ('"text"', bad("reply is not an object")),
    "null": ("null", bad("reply is not an object")),
    "number": ("5", bad("reply is not an object")),
    "wrapped": (f"[{G}]", FULL),
    "two objects": (f"{G},{G}", FELL | dict(summary="S.", label="positive")),
    "empty object": ("{}", EMPTY),
    "string people": (g('["A","B"]', '"Bob"'), FULL | dict(people=["B", "o", "b"])),
    "emoji people": (g('["A","B"]', '"é\U0001f600"'), FULL | dict(people=["é", "\U0001f600"])),
    "empty string people": (g('["A","B"]', '""'), FULL | dict(people=[])),
    "object people": (g('["A","B"]', '{"a":1,"b":2}'), FULL | dict(people=["a", "b"])),
    "object people in order": (g('["A","B"]', '{"z":1,"b":{"q":1},"a":2,"z":3}'), FULL | dict(people=["z", "b", "a"])),
    "repaired object people": (g('["A","B"]', '{"z":1,"b":2,}'), FULL | dict(parse_path="repaired", people=["z", "b"])),
    "object people and nan": (g('["A","B"]', '{"z":NaN,"b":2}'), FULL | dict(people=["b", "z"])),
    "entities twice": (g('"entities":', '"entities":{"people":{"z":1,"x":2}},"entities":').replace('["A","B"]', '{"k":1,"c":2}'),
                       FULL | dict(people=["c", "k"])),
    "null among people": (g('["A","B"]', '["A",null]'), FULL | dict(people=["A", "None"])),
    "null people": (g('["A","B"]', "null"), bad(TYPE)),
    "number people": (g('["A","B"]', "5"), bad(TYPE)),
    "bool places": (g('"places":[]', '"places":true'), bad(TYPE)),
    "missing people": (g('"people":["A","B"],', ""), FULL | dict(people=[])),
    "mixed people": (g('["A","B"]', '["A",1,"B"]'), FULL | dict(people=["A", "1", "B"])),
    "entities list": (g('{"people":["A","B"],"places":[],"organizations":["O"]}', "[1]"),
                      FULL | dict(people=[], orgs=[])),
    "text confidence": (g("0.9", '"high"'), FULL | dict(confidence=0.5)),
    "number as text": (g("0.9", '" 0.25 "'), FULL | dict(confidence=0.25)),
    "underscores": (g("0.9", '"1_0e-2"'), FULL | dict(confidence=0.1)),
    "java suffix": (g("0.9", '"0.7d"'), FULL | dict(confidence=0.5)),
    "text nan": (g("0.9", '"nan"'), FULL | dict(confidence=1.0)),
    "text -inf": (g("0.9", '"-inf"'), FULL | dict(confidence=0.0)),
    "above": (g("0.9", "7"), FULL | dict(confidence=1.0)),
    "below": (g("0.9", "-3.5"), FULL | dict(confidence=0.0)),
    "nan": (g("0.9", "NaN"), FULL | dict(confidence=1.0)),
    "-infinity": (g("0.9", "-Infinity"), FULL | dict(confidence=0.0)),
    "huge": (g("0.9", "1e400"), FULL | dict(confidence=1.0)),
    "true": (g("0.9", "true"), FULL | dict(confidence=1.0)),
    "false": (g("0.9", "false"), FULL | dict(confidence=0.0)),
    "null confidence": (g("0.9", "null"), FULL | dict(confidence=0.5)),
    "list confidence": (g("0.9", "[1]"), FULL | dict(confidence=0.5)),
    "no sentiment": (g('{"label":"positive","confidence":0.9}', '"good"'), FULL | dict(label="neutral", confidence=0.5)),
    "padded label": (g('"positive"', '" positive"'), FULL | dict(label="neutral")),
    "upper label": (g('"positive"', '"POSITIVE"'), FULL),
    "one question": (g('["q1","q2","q3"]', '"only"'), FULL | dict(questions=["only", PAD, PAD])),
    "null questions": (g('["q1","q2","q3"]', "null"), FULL | dict(questions=["None", PAD, PAD])),
    "odd questions": (g('["q1","q2","q3"]', "[1,null,true]"), FULL | dict(questions=["1", "None", "True"])),
    "four questions": (g('"q3"]', '"q3","q4"]'), FULL),
    "no questions": (g('["q1","q2","q3"]', "[]"), FULL | dict(questions=[PAD] * 3)),
    "null summary": (g('"S."', "null"), FULL | dict(summary="None")),
    "false summary": (g('"S."', "false"), FULL | dict(summary="False")),
    "blank summary": (g('"S."', '" \\u00a0"'), FULL | dict(summary=C.DEFAULT_SUMMARY)),
    "single quotes": ("{'summary': 'x'}", FELL),
    "raw tab": ('{"summary":"a\tb"}', FELL | dict(summary="a\tb")),
    "duplicate keys": ('{"summary":"x","summary":"y"}', EMPTY | dict(summary="y")),
    "unknown keys": ('{"summary":"x","other":{"a":[1]}}', EMPTY | dict(summary="x")),
    "closes the wrapper": ('{"summary":"a"}] {x}', FELL | dict(summary="a")),
    "closes both ways": ('{"summary":"a"}} {x}', FELL | dict(summary="a")),
    "number then garbage": ("1] foo", FELL),
    "bracket in text": ('{"summary":"a} ] {b}"}', EMPTY | dict(summary="a} ] {b}")),
    "comma in text stays": ('{"summary":"a, ]"}', EMPTY | dict(summary="a, ]")),
    "repair edits text": ('{"summary":"a, ]",}', EMPTY | dict(summary="a]", parse_path="repaired")),
    "escapes": ('{"summary":"\\u00e9\\n\\"q\\""}', EMPTY | dict(summary='é\n"q"')),
    "label case in fallback": ('"LABEL" : "POSITIVE"', FELL | dict(label="positive")),
    "other label in fallback": ('"label": "mixed"', FELL),
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, raw) for name, (raw, _) in CASES.items()]
    df = parse_replies(spark.createDataFrame(rows, "name string, raw string"))
    return {r.name: r for r in df.collect()}


@pytest.mark.parametrize("name", CASES)
def test_reply(parsed, name):
    row = parsed[name]
    entities, sentiment = row.entities, row.sentiment
    actual = dict(
        parse_path=row.parse_path, summary=row.summary,
        people=entities and entities.people, places=entities and entities.places,
        orgs=entities and entities.organizations, label=sentiment and sentiment.label,
        confidence=sentiment and sentiment.confidence, questions=row.key_questions,
        parse_error=row.parse_error, reason=row.reason,
    )
    assert actual == CASES[name][1]
    if sentiment:
        assert 0 <= sentiment.confidence <= 1 and not math.isnan(sentiment.confidence)
        assert len(row.key_questions) == 3


def test_filters_stay_above_the_parse(spark):
    df = parse_replies(spark.createDataFrame([("x",)], "raw string")).filter("parse_path <> 'failed'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") == 1 and plan.index("Filter") < plan.index("Generate")
    # a query that needs the path alone computes no other field
    paths = parse_replies(spark.createDataFrame([("x",)], "raw string")).groupBy("parse_path").count()
    assert "key_questions" not in paths._jdf.queryExecution().optimizedPlan().toString()
