import json

from siftloom.functions.solutions import first_solution

CASES = {
    '["", "a=1"]': "a=1", '"abc"': "abc", "print(1)": "print(1)", "123": None,
    '{"code":"x"}': "x", '[["",["q"]]]': "q", "": None, "  ": None, " x \n": "x",
    "[1,2] + x": "[1,2] + x", '["a"] + ["b"]': '["a"] + ["b"]',
    '["123","null","ok"]': "ok", '["\\"q\\"", "z"]': "q", '[NaN, "x"]': "x", "NaN": None,
    "-Infinity": None, "1e5": None, "01": "01", '"""doc"""': '"""doc"""',
    '{"solution":"","code":["",{"completion":"deep"}]}': "deep",
    "[x for x in y]": "[x for x in y]", '["  a \\n"]': "a", "[]": None, '[""]': None, "{}": None,
    '{"other":1}': None, "['a']": "['a']", '["a",]': '["a",]', '[null,"b"]': "b", "true": None,
    "truex": "truex", '["{\\"code\\": \\"z\\"}"]': "z", '["a\nb"]': '["a\nb"]',
    '["\\ud83d\\ude00"]': "\U0001f600", '["' + "y" * 200_000 + '"]': "y" * 200_000,
}


def test_first_solution(column):
    assert column(first_solution, list(CASES)) == list(CASES.values())
    assert column(first_solution, [None]) == [None]


def test_built_in_and_python_path_agree(column):
    plain = ["def f():\n  return 'é'", "a", "x" * 50, "// 1"]
    listed = [json.dumps(["", text, "later"]) for text in plain]
    nested = [json.dumps({"solution": [text]}) for text in plain]
    assert column(first_solution, listed) == plain == column(first_solution, nested)
