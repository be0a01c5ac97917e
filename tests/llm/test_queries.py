from ledgerloom.llm import queries


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.registered())
    assert numbers == list(range(1, 14))


def test_statements_are_texts_of_registered_queries():
    found = queries.statements()
    assert set(found) <= set(queries.registered())
    assert all(isinstance(sql, str) for sql in found.values())
