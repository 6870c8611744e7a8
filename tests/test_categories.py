from footfall.operators import categories, sessions


def test_an_action_counts_once_click_first(actions, rows):
    every = {"click_category_id": "1", "order_category_ids": "2", "pay_category_ids": "3"}
    df = actions([("s", 0, every), ("s", 1, {**every, "click_category_id": ""}),
                  ("s", 2, {"order_category_ids": "2"}), ("s", 3, {"search_keyword": "k"}),
                  ("s", 4, {"click_category_id": None, "pay_category_ids": None, "order_category_ids": "2"})])
    assert rows(categories.category_action_counts(df)) == [("1", "click", 1), ("2", "order", 2), ("3", "pay", 1)]
    assert rows(categories.category_pivot(df)) == [("1", 1, 0, 0), ("2", 0, 2, 0), ("3", 0, 0, 1)]


def test_id_lists(actions, rows):
    df = actions([("s", 0, {"order_category_ids": "1,2"}), ("s", 1, {"pay_category_ids": "2, 3"})])
    assert rows(categories.category_action_counts(df)) == [("1,2", "order", 1), ("2, 3", "pay", 1)]
    assert rows(categories.category_action_counts(df, explode_ids=True)) == [
        ("1", "order", 1), ("2", "order", 1), ("2", "pay", 1), ("3", "pay", 1)]


def test_order_of_the_top(actions):
    counts = {"a": (2, 1, 0), "b": (2, 2, 0), "c": (2, 2, 1), "e": (1, 9, 9), "d": (1, 9, 9), "f": (3, 0, 0)}
    kinds = ("click_category_id", "order_category_ids", "pay_category_ids")
    df = actions([("s", 0, {kind: c}) for c, ns in counts.items() for kind, n in zip(kinds, ns) for _ in range(n)])
    top = [tuple(r) for r in categories.top_categories(df).collect()]
    assert [r[0] for r in top] == ["f", "c", "b", "a", "d", "e"]
    assert top[1] == ("c", 2, 2, 1)
    assert [r.category_id for r in categories.top_categories(df, 2, task_id="t").collect()] == ["f", "c"]


def test_top_sessions_ties_go_by_id(actions, rows):
    df = actions([(f"s{i:02}", t, {"click_category_id": "x"}) for i in range(11) for t in range(2 if i == 10 else 1)]
                 + [("z", 0, {"click_category_id": "rare"})])
    top = rows(categories.top_sessions(df, n_categories=1))
    assert top == [("x", f"s{i:02}", 1) for i in range(9)] + [("x", "s10", 2)]
    assert ("rare", "z", 1) in rows(categories.top_sessions(df, n_categories=2))


def test_counting_before_the_users_gives_the_same(spark, actions, users, rows):
    """Half of the actions are of a user that is not kept; filters on behaviour go by the sessions."""
    def some(user):
        return actions([(f"s{user}{i % 4}", i, {("click_category_id", "pay_category_ids", "order_category_ids")[i % 3]:
                        str(i % 5), "search_keyword": "tea" if i == 3 else ""}) for i in range(40)], user=user)

    every, people = some(1).union(some(2)), users((1, 30, "a", "x", "male"), (3, 30, "a", "x", "male"))
    for flt in (sessions.NO_FILTER, sessions.SessionFilter(keywords="tea")):
        kept = sessions.kept_actions(every, people, flt)
        assert kept.count() == (10 if flt.keywords else 40)
        assert rows(categories.kept_category_counts(every, people, flt)) == rows(
            categories.category_action_counts(kept))
        assert rows(categories.pivot_counts(categories.kept_category_counts(every, people, flt))) == rows(
            categories.category_pivot(kept))
        assert categories.kept_top_categories(every, people, flt, 3).collect() == categories.top_categories(
            kept, 3).collect()
        assert rows(categories.kept_session_category_clicks(every, people, flt)) == rows(
            categories.session_category_clicks(kept))
        assert rows(categories.kept_top_sessions(every, people, flt, 2, 2)) == rows(categories.top_sessions(kept, 2, 2))


def test_users_meet_counts_not_actions(spark, actions, users):
    """With broadcasts off, what is shuffled by user alone has been counted before."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = actions([("s", 0, {"click_category_id": "x"})])
        plan = categories.kept_top_categories(df, users((1, 30, "a", "x", "male")))
        lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    at = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line]
    counted = [i for i in at if any("Aggregate" in line and "count(1)" in line for line in lines[i + 1:i + 4])]
    assert counted and all(i in counted or "category_id" not in lines[i] for i in at)


def test_busy_category_is_cut_before_the_shuffle(actions):
    plan = categories.top_sessions(actions([("s", 0, {"click_category_id": "x"})]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 10, Partial" in text and "BroadcastHashJoin" in text and "TakeOrdered" in text
