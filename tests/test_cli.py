"""The command line runs all layers and appends the step log."""

import os

from fixtures import build_inbound
from ledgerline.__main__ import main
from ledgerline.layout import Layout
from ledgerline.plans.calltree import call_tree
from ledgerline.plans.runlog import file_trace, read_log, trace


def test_cli_all_layers_and_log_tree(spark, root):
    build_inbound(root)
    assert main(["all", "--root", root, "--parent-guid", "caller-1"]) == 0
    assert main(["bronze", "--root", root, "--source", "newbank"]) == 0
    lay = Layout(root)
    log = read_log(spark, lay.log)
    actions = {r["Action"] for r in log.collect()}
    assert {"Main", "LoadFileToBronze", "LoadBronzeToSilver", "LoadSilverToGold"} <= actions
    warn = log.where("Action = 'Main' AND Severity = 'Error'").first()
    made = f"{lay.bronze_inbound}/newbank"
    assert os.path.isdir(made) and made in warn["Result"]
    tree = call_tree(log.select("ExecutionGUID", "ParentExecutionGUID"))
    roots = {r["node"] for r in tree.where("depth = 0").collect()}
    # the two runs' Main steps hang under their callers, which are not in the log
    assert len(roots) == 2
    assert tree.count() == log.select("ExecutionGUID").distinct().count()
    main_guid = log.where("Action = 'LoadFileToBronze'").orderBy("Begin").first()["ExecutionGUID"]
    steps = {r["Action"] for r in trace(log, main_guid).collect()}
    assert steps == {"LoadFileToBronze", "RetrieveConfigurations", "DiscoverInbound",
                     "ValidateColumnHeaders", "WriteBronze", "RecordDispositions"}
    hist = file_trace(spark, lay, "extra.csv").collect()
    assert {r["Issue"] for r in hist} == {"ExtraColumns"}
    assert "WriteBronze" in {r["Step"] for r in hist}
