"""The whole experiment from CSV extracts and term files in a data folder."""

import os
import tempfile

from phenoscope.plans import experiment
from phenoscope.plans.queries import phenotype_labels
from phenoscope.sources.csv import write_csv_table
from phenoscope.sources.standin import raw_tables

SF_DIR = "/root/testdata/sf0.001"


def test_run_from_files(spark):
    d = tempfile.mkdtemp()
    for stem, df in raw_tables(spark, SF_DIR).items():
        write_csv_table(df, os.path.join(d, f"{stem}.csv"))
    # term file with bare-CR separators and mixed case, as shipped
    with open(os.path.join(d, "med_filter.txt"), "wb") as f:
        f.write(b"Lantus\rinsulin nph\nMETFORMIN\nglipizide\n")
    labels, report = experiment.run(spark, d)
    expected = {(r.patient_id, r.label) for r in phenotype_labels(spark, SF_DIR).collect()}
    assert {(r.patient_id, r.label) for r in labels.collect()} == expected
    rows = report.collect()
    assert len(rows) == 6
    assert all(r.n > 0 and 0 < r.purity <= 1 for r in rows)
    lines = experiment.report_lines(report)
    assert lines[0].startswith("[All feature] patients: ")
    assert lines[2].startswith("[All feature] purity of kMeans is: ")
