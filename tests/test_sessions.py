from footfall.operators import sessions
from footfall.operators.sessions import SessionFilter

SECONDS = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEPS = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]


def test_visit_bucket_edges(actions):
    rows = [(f"s{s}", t, {}) for s in SECONDS for t in (0, s)]
    out = sessions.visit_buckets(sessions.session_rollup(actions(rows))).first().asDict()
    assert out.pop("session_count") == len(SECONDS)
    assert out.pop("visit_0s_count") == 1
    assert out == {f"visit_{b}_count": n for b, n in [
        ("1s_3s", 2), ("4s_6s", 2), ("7s_9s", 2), ("10s_30s", 2), ("30s_60s", 2), ("1m_3m", 2), ("3m_10m", 2),
        ("10m_30m", 2), ("30m", 1)]}


def test_step_bucket_edges(actions):
    rows = [(f"s{n}", i, {}) for n in STEPS for i in range(n)]
    out = sessions.step_buckets(sessions.session_rollup(actions(rows))).first().asDict()
    assert out.pop("session_count") == len(STEPS) == sum(out.values())
    assert out == {f"step_{b}_count": n for b, n in [
        ("1_3", 2), ("4_6", 2), ("7_9", 2), ("10_30", 2), ("30_60", 2), ("60", 1)]}


def test_rollup_sets_and_user(actions):
    df = actions([("s", 5, {"search_keyword": "b"}), ("s", 2, {"search_keyword": "a"}),
                  ("s", 9, {"click_category_id": "7"}), ("s", 3, {"search_keyword": "b"})])
    row = sessions.session_rollup(df, with_sets=True).first()
    assert (row.search_keywords, row.click_category_ids, row.step_length, row.visit_length, row.user_id) == (
        "a|b", "7", 4, 7, 1)
    assert row.start_time.second == 2 and row.end_time.second == 9


def test_ratios_round_half_up(actions, users):
    """57 sessions of 200 take two seconds: 0.285 becomes 0.29."""
    rows = [(f"s{i}", t, {}) for i in range(200) for t in (0, 2 if i < 57 else 5)]
    row = sessions.session_aggr_stat(actions(rows), users((1, 30, "j", "c", "male")), task_id="t").first()
    assert row.task_id == "t" and row.session_count == 200
    assert row.visit_length_1s_3s_ratio == 0.29 and row.visit_length_4s_6s_ratio == 0.72
    assert row.step_length_1_3_ratio == 1.0 and row.visit_length_30m_ratio == 0.0


def test_no_sessions(actions, users):
    row = sessions.session_aggr_stat(actions([("s", 0, {})]).where("false"),
                                     users((1, 30, "j", "c", "male"))).first().asDict()
    assert row.pop("session_count") == 0 and set(row.values()) == {None}


def test_filters(actions, users, rows):
    df = actions([("a", 0, {"search_keyword": "tea"}), ("a", 1, {"click_category_id": "5"})], user=1)
    for user in (2, 3, 4, 9):
        df = df.unionByName(actions([(f"s{user}", 0, {"search_keyword": "x"}),
                                     (f"s{user}", 1, {"click_category_id": str(user)})], user=user))
    people = users((1, 19, "cook", "1", "male"), (2, 20, "cook", "2", "female"), (3, 50, "nurse", "3", "male"),
                   (4, 51, "nurse", "4", "male"))

    def kept(**flt):
        flt = SessionFilter(**flt)
        by_session = {r.session_id for r in sessions.kept_sessions(df, people, flt).collect()}
        by_action = sessions.kept_actions(df, people, flt)
        assert by_action.columns == df.columns
        assert {r.session_id for r in by_action.collect()} == by_session
        assert by_action.count() == 2 * len(by_session)
        return by_session

    assert kept() == {"a", "s2", "s3", "s4"}              # user 9 is unknown
    assert kept(start_age=20, end_age=50) == {"s2", "s3"}  # both ends count
    assert kept(professionals="cook, pilot") == {"a", "s2"}
    assert kept(cities=[3, 4]) == {"s3", "s4"}
    assert kept(sex="male") == {"a", "s3", "s4"}
    assert kept(keywords="tea,milk") == {"a"}
    assert kept(category_ids="3,4") == {"s3", "s4"}
    assert kept(keywords="x", category_ids="3,5") == {"s3"}  # each by some action of the session
    assert kept(start_age="", end_age="", sex="") == {"a", "s2", "s3", "s4"}


def test_join_users_brings_attributes(actions, users):
    joined = sessions.join_users(sessions.session_rollup(actions([("s", 0, {})], user=3)),
                                 users((3, 41, "nurse", "7", "female"))).first()
    assert (joined.age, joined.professional, joined.city, joined.sex) == (41, "nurse", "7", "female")


def test_row_ids_differ(spark):
    ids = [r.task_id for r in sessions.with_row_id(spark.range(3)).collect()]
    assert len(set(ids)) == 3
