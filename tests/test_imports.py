import importlib
import pkgutil

import pytest

import tidewell

MODULES = [m.name for m in pkgutil.walk_packages(tidewell.__path__, "tidewell.") if ".llm" not in m.name]


@pytest.mark.parametrize("name", MODULES)
def test_module_imports(name):
    importlib.import_module(name)


def test_nothing_else_imports_the_llm_package():
    from pathlib import Path

    root = Path(tidewell.__file__).parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "tidewell.llm" not in path.read_text(), path
