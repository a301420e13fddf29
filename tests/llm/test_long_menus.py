"""A menu is navigation however long its line is."""

from tamiz.llm import quality_rules


def test_long_menu_lines_are_navigation():
    line = " · ".join(f"Departmentname{i}" for i in range(30))
    assert len(line) >= 400 and len(line.split()) < 80
    assert quality_rules.line_fault(line, line.split()) == "navigation"
    text = line + "\n" + " ".join(f"word{i}" for i in range(30)) + "."
    assert quality_rules.judge(text)[7] == 1
