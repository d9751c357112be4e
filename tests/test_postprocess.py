import pytest
from pyspark.sql import functions as F

from palimpsest.operators import correct, gate, service, validate


def outputs(spark, confidences):
    return spark.createDataFrame([(i, f"l{i}", "t", c) for i, c in enumerate(confidences)], "ord long, line_id string, top1_text string, sequence_confidence double")


@pytest.mark.parametrize("confidences, most, flagged", [
    ([0.9, 0.8, 0.95], None, []), ([0.3, 0.4, 0.5], None, [0, 1, 2]), ([0.9, 0.3, 0.8, 0.1], None, [1, 3]), ([0.1] * 10, 3, [0, 1, 2]), ([0.7, None], None, []), ([0.1, 0.1], 0, []), ([], 2, []),
])
def test_gate(spark, confidences, most, flagged):
    rows = gate.gate(outputs(spark, confidences), max_flags=most)
    assert sorted(r.ord for r in rows.where("gate = 'flagged'").collect()) == flagged and rows.count() == len(confidences)


def test_overflow_comes_after_the_accepted(spark):
    flagged, accepted = gate.parts(gate.gate(outputs(spark, [0.1, 0.2, 0.9, 0.1]), max_flags=1))
    assert [r.ord for r in flagged.collect()] == [0] and [r.ord for r in accepted.orderBy("rank_key").collect()] == [2, 1, 3]
    assert gate.invocation_rate(gate.gate(outputs(spark, [0.1, 0.9]))).first().invocation_rate == 0.5


def test_requests(spark):
    class Failing:
        def complete(self, prompt):
            raise RuntimeError("down")

    rows = spark.createDataFrame([("1", "eñ la çibdad", ["eñ la çibdad", "en la ciudad"]), ("2", "one\ntwo", ["one\ntwo"])], "line_id string, text string, nbest array<string>")
    got = {r.line_id: r for r in correct.request(rows, correct.EchoClient()).collect()}
    assert got["1"].candidate_text == "eñ la çibdad" and got["1"].decision == "pending" and "Alternative readings: en la ciudad\n" in got["1"].prompt
    assert got["2"].candidate_text == "one" and "(none)" in got["2"].prompt
    assert {r.candidate_text for r in correct.request(rows, Failing()).collect()} == {"eñ la çibdad", "one\ntwo"}
    echo = rows.select(correct.echoed(correct.prompt(F.col("text"), F.col("nbest"))).alias("e")).collect()
    assert [r.e for r in echo] == ["eñ la çibdad", "one"]


LETTERS = "abcdefghijklmnopqrstuvwxyz "


@pytest.mark.parametrize("original, candidate, options, code", [
    ("holla", "hola", {}, None), ("hola", "", {}, "empty"), ("hola", "   ", {}, "empty"), ("hola", " \t", {}, "empty"), ("hola", None, {}, "empty"), ("hi", "a" * 100, {}, "length_ratio"), ("abcd", "ab", {}, None), ("abcde", "ab", {}, "length_ratio"),
    ("hello", "hel1o", {"allowed": LETTERS}, "characters"), ("dios mio", "dios mío", {"lexicon": True}, None), ("dios mio", "xyz abc", {"lexicon": True}, "lexicon"), ("nada mio", "xyz abc", {"lexicon": True}, None),
])
def test_validation(spark, original, candidate, options, code):
    audit = spark.createDataFrame([("k", original, candidate)], "line_id string, input_text string, candidate_text string")
    if options.get("lexicon"):
        options = options | {"lexicon": spark.createDataFrame([("dios", 1.0)], "word string, score double")}
    row = validate.validate(audit, **options).first()
    assert (row.reason_code, row.decision) == (code, "rejected" if code else "accepted")
    assert (row.decision_reason == "all checks passed") == (code is None)
    assert audit.columns == ["line_id", "input_text", "candidate_text"]


def test_rates(spark):
    audit = spark.createDataFrame([("1", "a", "a"), ("2", "a", ""), ("3", "a", " ")], "line_id string, input_text string, candidate_text string")
    done = validate.validate(audit)
    assert validate.acceptance_rate(done).first().acceptance_rate == pytest.approx(1 / 3)
    assert [(r.reason_code, r.n) for r in validate.reject_reasons(done).collect()] == [("empty", 2)]


def test_page_texts_and_backends(spark):
    lines = spark.createDataFrame([("p", 1, "mundo", 0.5), ("p", 0, "hola", 0.7), ("q", 0, "", 0.2)], "page string, line_id int, text string, sequence_confidence double")
    got = {r.page: r for r in service.page_texts(lines).collect()}
    assert got["p"].text == "hola mundo" and got["p"].confidence == pytest.approx(0.6) and got["q"].text == ""
    assert service.runtime(spark).first().spark == spark.version


def test_settings_from_the_environment():
    assert service.Settings.from_environment({}) == service.Settings()
    assert service.Settings.from_environment({"PALIMPSEST_DPI": "150", "PALIMPSEST_THRESHOLD": "0.5", "DPI": "1"}) == service.Settings(dpi=150, threshold=0.5)
    with pytest.raises(ValueError, match="PALIMPSEST_BEAM_WIDTH"):
        service.Settings.from_environment({"PALIMPSEST_BEAM_WIDTH": "wide"})


def test_large_lexicon_gives_the_same(spark, monkeypatch):
    rows = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate([("dios mio", "dios mío"), ("dios mio", "xyz abcd"), ("abc def", "xyz abcd"), (None, "dios"), ("dios", None)])], "line_id long, input_text string, candidate_text string")
    words = spark.createDataFrame([("dios", 1.0), ("rey", 2.0), ("it's \\ 'quoted'", 1.0), (None, 1.0)], "word string, score double")
    found = lambda: [tuple(r) for r in validate.validate(rows, lexicon=words).select("line_id", "decision", "reason_code").orderBy("line_id").collect()]
    few = found()
    monkeypatch.setattr(validate, "SMALL", 1)
    assert found() == few and few[1][2] == "lexicon" and few[0][1] == "accepted"
    same = rows.withColumn("line_id", F.when(rows.line_id > 2, 7)).union(rows.withColumn("line_id", F.lit(7).cast("long")))
    judged = lambda: sorted(tuple(r) for r in validate.validate(same, lexicon=words).select(F.coalesce("line_id", F.lit(-1)), "input_text", "candidate_text", "decision").collect())
    large = judged()
    monkeypatch.setattr(validate, "SMALL", 100)
    assert judged() == large and len(large) == 10 and validate.validate(same, lexicon=words).columns[:3] == rows.columns
    assert validate.validate(rows, lexicon=words.limit(0)).where("reason_code = 'lexicon'").count() == 0
