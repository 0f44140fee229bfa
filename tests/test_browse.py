import pytest

from perigee.operators import browse


def keys(df):
    return [r["approach_id"] for r in df.collect()]


def test_pages_tile_the_table(approaches):
    total = approaches.count()
    near = keys(browse.page(approaches, 300, 600))
    far = browse.page(approaches, 300, 600)
    assert keys(far) == near and far.first()["total"] == total
    assert keys(browse.page(approaches, 10, total)) == []
    assert keys(browse.page(approaches, 10, total + 5)) == []
    assert keys(browse.page_after(approaches, near[0] - 1, 300)) == near


@pytest.mark.parametrize("limit, offset", [(0, 0), (1001, 0), (10, -1)])
def test_page_bounds(approaches, limit, offset):
    with pytest.raises(ValueError):
        browse.page(approaches, limit, offset)


def test_search_pattern_literal_and_missing_names(spark):
    df = spark.createDataFrame([(1, "(2000 SS1)"), (2, "(2001 ss2)"), (3, None)], "approach_id int, name string")
    assert keys(browse.search_name(df, "ss")) == [1, 2]
    assert keys(browse.search_name(df, "(2000 ss1)")) == [1]
    assert keys(browse.search_name(df, "(2000", literal=True)) == [1]
    assert browse.search(df, "ss", limit=1).first()["total"] == 2
    with pytest.raises(ValueError):
        browse.search_name(df, "  ")
    with pytest.raises(ValueError):
        browse.search(df, "ss", limit=501)


def test_lookup(approaches):
    assert browse.by_id(approaches, -1).count() == 0
    some = approaches.first()["id"]
    first = approaches.where(f"id = {some}").agg({"approach_id": "min"}).first()[0]
    assert keys(browse.by_id(approaches, some)) == [first]
    many = browse.first_of_each(approaches, approaches.select("id"))
    assert many.count() == approaches.select("id").distinct().count()


def test_head_tail_and_cards(approaches):
    assert keys(browse.head(approaches)) == [0, 1, 2, 3, 4]
    assert keys(browse.tail(approaches)) == [995, 996, 997, 998, 999]
    assert browse.card_view(approaches).columns == ["id", "name", "velocity", "missDistance", "magnitude"]
    assert browse.page_envelope(approaches, 7, 3).first()["count"] == 7


def test_pages_of_repeating_and_missing_keys(spark):
    rows = [(i, i // 4 if i < 12 else None) for i in range(16)]
    df = spark.createDataFrame(rows, "approach_id long, k long")
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] if r[1] is not None else -1, r[0]))
    for offset in (0, 1, 3, 4, 6, 11, 15, 16, 40):
        got = [(r["approach_id"], r["k"]) for r in browse.page(df, 5, offset, "k", "approach_id").collect()]
        assert got == want[offset : offset + 5]


def test_search_folds_all_letters(spark):
    df = spark.createDataFrame([(1, "BJÖRN"), (2, "x"), (3, None)], "approach_id long, name string")
    assert [r["approach_id"] for r in browse.search_name(df, "björn").collect()] == [1]
    assert [tuple(r) for r in browse.search_envelope(df, "nobody").collect()] == [("nobody", 0, 0, [])]
