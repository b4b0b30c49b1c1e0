"""Whole tokens, all languages, all letters: nothing is cut off or left out."""

from sedimenta.llm import language, quality
from sedimenta.llm.common import held_out
from tests.fixtures import plan_of
from tests.llm import fixtures

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], SCHEMA)


def test_shape_of_a_whole_token():
    assert quality.shape("a" * 64 + "Zm9v+/" * 60) != quality.shape("a" * 500)
    assert quality.shape("x" * 100_000 + "7") == "a0"
    features = quality.Features(10)
    features.read("short " + "y" * 1000)
    assert set(features) == {"short"}


def test_languages_with_long_texts_only(spark):
    english = [(fixtures.sentence(i, 60), "en") for i in range(60)]
    german = [("über die straße zum grünen fluß gehen wir täglich " * 900, "de") for _ in range(40)]
    trees = language.learn(docs(spark, english + german))
    assert trees.languages == ("de", "en")
    found = language.identify(docs(spark, [("wir gehen zum fluß", None), (fixtures.sentence(99, 9), None)]), trees).collect()
    assert [r["lang_pred"] for r in sorted(found, key=lambda r: r["doc_id"])] == ["de", "en"]


def test_no_language_is_left_out(spark):
    rows = [(f"wort{i} " * 5, f"l{i % 520:03d}") for i in range(3000)]
    trees = language.learn(docs(spark, rows), rows=600)
    assert len(trees.languages) == 520


def test_texts_without_letters_are_undetermined(spark):
    trees = language.learn(docs(spark, [(fixtures.sentence(i, 60), "en") for i in range(20)]))
    texts = ["\xbd \xb2", "①Ⅷ", "12_3", "", None, "ª", "中", "x"]
    found = language.identify(docs(spark, [(t, None) for t in texts]), trees).collect()
    named = {r["doc_id"]: (r["lang_pred"], r["score"] > 0) for r in found}
    assert [named[i] for i in range(8)] == [("und", False)] * 5 + [("en", True)] * 3


def test_sample_has_the_least_hashes_and_sorts_no_language(spark):
    able = spark.range(40_000).selectExpr("id", "IF(id % 9 < 7, 'a', 'b') AS lang")
    sizes = [(r["lang"], r["count"]) for r in able.groupBy("lang").count().collect()]
    found = language.sampled(able, sizes, 300)
    for lang in "ab":
        every = able.where(f"lang = '{lang}'").selectExpr("id", "xxhash64(id) AS h").collect()
        # The hash as an unsigned number below its bound, then in signed order.
        bound = min(1.0, (300 + 10 * 300**0.5 + 50) / len(every))
        passed = [r for r in every if ((r["h"] % (1 << 64)) >> 11) / (1 << 53) < bound]
        assert 300 <= len(passed) < 700
        want = {r["id"] for r in sorted(passed, key=lambda r: (r["h"], r["id"]))[:300]}
        assert {r["id"] for r in found.where(f"lang = '{lang}'").collect()} == want
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and plan.index("Window") < plan.index("BroadcastHashJoin")


def test_held_out_rows_teach_nothing(spark):
    rows = docs(spark, [(f"nur{i} " * 9, "zz") for i in range(200)])
    kept = rows.where(held_out(rows["doc_id"]))
    assert kept.count() and language.learn(kept).languages == ()
