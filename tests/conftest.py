from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driftgate.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return local_session("local[*]")


@pytest.fixture(scope="session")
def employees(spark, tmp_path_factory):
    """A baseline / drifted CSV pair of our own with the shape of the reference sample:
    25 rows each; department 4 values (9, 6, 5, 5), status 23 / 2, location (9, 8, 8),
    hire_date and salary all distinct; the drifted file collapses four columns."""
    d = tmp_path_factory.mktemp("employees")
    header = "employee_id,first_name,last_name,department,hire_date,status,salary,location\n"
    depts = ["Engineering"] * 9 + ["Sales"] * 6 + ["Finance"] * 5 + ["Support"] * 5
    status = ["Active"] * 23 + ["Terminated"] * 2
    locs = ["Austin"] * 9 + ["Denver"] * 8 + ["Portland"] * 8
    base, drifted = [header], [header]
    for i in range(25):
        row = [f"X{i:03d}", f"first{i}", f"last{i}"]
        hire = f"2020-{1 + i % 12:02d}-{1 + i:02d}"
        base.append(",".join(row + [depts[i], hire, status[i], str(50000 + 1000 * i), locs[i]]) + "\n")
        drifted.append(",".join(row + ["Engineering", hire, "Active", "95000", "Portland"]) + "\n")
    (d / "base.csv").write_text("".join(base))
    (d / "drifted.csv").write_text("".join(drifted))
    return str(d / "base.csv"), str(d / "drifted.csv")
