"""Nested criteria in three-valued logic: one person per case, all evaluated together."""

import pytest

from cohortloom.operators import criteria as K

YES_NO = [(n, n, ["yes"], [], ["no"], None) for n in ("stem", "e1", "e2", "a1", "a2", "a3", "a4", "a5", "high", "cross", "low", "flat")]
LEAVES = [*YES_NO, ("three", "signs", [], [], None, 3), ("talk", "signs", ["talkative"], [], None, None), ("long", "length", [], ["week or more", "four days"], None, None), ("trouble", "harm", [], ["caused problems"], None, None), ("several", "times", [], ["several"], None, None)]
DEFINED = [
    K.anxiety("gad", "stem", ["e1", "e2"], ["a1", "a2", "a3", "a4", "a5"]), K.episode("mania", ["high", "cross"], ["three"]), K.episode("bipolar", [], ["long", "trouble"], of="mania"),
    K.episode("depressed", ["low", "flat"], []), K.episode("recurrent", [], ["several"], of="depressed"), K.symptoms_by_screener("sign", "high", ["talk"])]
WANTED = ["gad", "mania", "bipolar", "depressed", "recurrent", "sign__talk"]
MANIC = {"high": ["Yes"], "signs": ["Talkative", "Restless", "Confident"]}
CASES = {
    "gad: case": ({"stem": ["Yes"], "e1": ["No"], "e2": ["Yes"], "a1": ["Yes"], "a2": ["Yes"], "a3": ["Yes"]}, {"gad": 1}),
    "gad: no stem": ({"stem": ["No"]}, {"gad": 0}),
    "gad: unknown stem, though the rest rules it out": ({"e1": ["No"], "e2": ["No"]}, {}),
    "gad: both kinds of excessive worry denied": ({"stem": ["Yes"], "e1": ["No"], "e2": ["No"]}, {"gad": 0}),
    "gad: one denied, one unknown": ({"stem": ["Yes"], "e1": ["No"], "a1": ["Yes"], "a2": ["Yes"], "a3": ["Yes"]}, {}),
    "gad: three signs denied": ({"stem": ["Yes"], "a1": ["No"], "a2": ["No"], "a3": ["No"], "a4": ["Yes"], "a5": ["Yes"]}, {"gad": 0}),
    "gad: two denied, the others could be enough": ({"stem": ["Yes"], "e1": ["Yes"], "a1": ["No"], "a2": ["No"], "a4": ["Yes"], "a5": ["Yes"]}, {}),
    "mania: case": ({**MANIC, "length": ["A week or more"], "harm": ["It caused problems at work"]}, {"mania": 1, "bipolar": 1, "sign__talk": 1}),
    "mania: no core episode": ({"high": ["No"], "signs": ["Talkative", "Restless", "Confident"]}, {"mania": 0, "bipolar": 0, "sign__talk": 0}),
    "mania: the other core question alone": ({"cross": ["No"]}, {"mania": 0, "bipolar": 0}),
    "mania: two signs": ({"high": ["Yes"], "signs": ["Restless", "Confident"]}, {"mania": 0, "bipolar": 0, "sign__talk": 0}),
    "mania: signs not answered": ({"cross": ["Yes"]}, {"mania": 0, "bipolar": 0}),
    "bipolar: too short": ({**MANIC, "length": ["One day"], "harm": ["It caused problems"]}, {"mania": 1, "bipolar": 0, "sign__talk": 1}),
    "bipolar: harm not answered": ({**MANIC, "length": ["At least four days"]}, {"mania": 1, "bipolar": 0, "sign__talk": 1}),
    "depressed: one of two denied, the other unknown": ({"low": ["No"]}, {"depressed": 0, "recurrent": 0}),
    "depressed: several episodes": ({"low": ["No"], "flat": ["Yes"], "times": ["Several"]}, {"depressed": 1, "recurrent": 1}),
    "recurrent: number not answered": ({"low": ["Yes"]}, {"depressed": 1, "recurrent": 0}),
    "depressed: neither yes nor no": ({"low": ["Maybe"]}, {}),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(name, q, a, 40.0) for name, (given, _) in CASES.items() for q, listed in given.items() for a in listed] + [("no age", "stem", "No", None)]
    nodes, edges = (sum((d[k] for d in DEFINED), []) for k in (0, 1))
    tables = [spark.createDataFrame(x, schema) for x, schema in ((LEAVES, K.LEAVES), (nodes, K.NODES), (edges, K.EDGES))]
    out = {}
    for r in K.diagnoses(spark.createDataFrame(rows, "pid string, qid string, answer string, age double"), *tables, WANTED).collect():
        assert r.age == 40.0 and r.pheno_id not in out.setdefault(r.pid, {})
        out[r.pid][r.pheno_id] = r.y
    return out


@pytest.mark.parametrize("case", CASES)
def test_case(found, case):
    assert found.get(case, {}) == CASES[case][1]


def test_without_age_nothing_is_made(found):
    assert "no age" not in found


def test_criteria_that_contain_each_other_raise(spark):
    with pytest.raises(ValueError, match="contain each other"):
        K._levels(spark.createDataFrame([("a", "b", "part", "unknown"), ("b", "a", "part", "unknown")], K.EDGES))
