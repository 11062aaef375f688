"""What workers keep between tasks of one stage, and let go of before another's."""

from tributary.llm import memory


def test_other_stages_results_are_forgotten():
    made = []

    @memory.kept(2)
    def one(key):
        made.append(("one", key))
        return key

    @memory.kept(2)
    def two(key):
        made.append(("two", key))
        return key

    def stage(batches):
        for b in batches:
            yield one(b), two(b)

    run = memory.given_back(stage, "one")
    assert list(run([1, 1])) == [(1, 1), (1, 1)] and made == [("one", 1), ("two", 1)]
    assert list(run([1])) == [(1, 1)] and made[2:] == [("two", 1)]
    assert list(memory.given_back(stage)([1])) == [(1, 1)] and made[3:] == [("one", 1), ("two", 1)]
    for name in ("one", "two"):
        del memory._kept[name]
