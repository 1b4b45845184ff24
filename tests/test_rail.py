"""Rail messages: single vs repeated elements, missing arr/dep, tombstones."""

from kestrel.operators import rail as RL

MSG_TS = ('<Pport ts="2024-01-01T10:00:00.000000" seq="1"><uR updateOrigin="TD" requestSource="x">'
          '<TS rid="R1" uid="U1" ssd="2024-01-01">'
          '<fc:Location xmlns:fc="urn:f" tpl="A" wta="23:58" wtd="23:59"><fc:arr at="00:03"/>'
          '<fc:plat platsrc="P">4</fc:plat></fc:Location>'
          '</TS></uR></Pport>')
MSG_TS2 = ('<Pport ts="2024-01-01T10:01:00.000000" seq="2"><uR updateOrigin="TD" requestSource="x">'
           '<TS rid="R1" uid="U1" ssd="2024-01-01">'
           '<Location tpl="B" wta="10:00" wtd="10:01"><dep et="10:01"/></Location>'
           '<Location tpl="C" wtp="10:10"><pass et="10:12"/></Location>'
           '</TS></uR></Pport>')
SCHED = ('<Pport ts="2024-01-01T09:00:00.000000" seq="0"><uR><schedule rid="R1" uid="U1" trainId="1A01" toc="SW" '
         'ssd="2024-01-01" trainCat="OO"><OR tpl="A" wtd="09:00"/><IP tpl="B" wta="09:10" wtd="09:11"/>'
         '<DT tpl="C" wta="09:30"/></schedule></uR></Pport>')
SCHED2 = SCHED.replace('rid="R1"', 'rid="R2"').replace('seq="0"', 'seq="3"')
DEACT = '<Pport ts="2024-01-01T11:00:00.000000" seq="4"><uR><deactivated rid="R1"/></uR></Pport>'


def _parsed(spark, msgs):
    return RL.parse_messages(spark.createDataFrame([(m,) for m in msgs], "value string"))


def test_forecast_edges_single_location_midnight_and_missing_times(spark):
    e = {r.tpl: r for r in RL.forecast_edges(_parsed(spark, [MSG_TS, MSG_TS2])).collect()}
    assert e["A"].ad == 5 and e["A"].dd == 0 and e["A"].delayed is True and e["A"].platform == "4"
    assert e["B"].ad == 0 and e["B"].dd == 0 and e["B"].delayed is False   # no arr element
    assert e["C"].pd == 2 and e["C"].delayed is True
    assert e["A"].edge_id == "R1A"


def test_schedule_edges_types_and_ids(spark):
    e = RL.schedule_edges(_parsed(spark, [SCHED])).collect()
    assert sorted((r.type, r.edge_id) for r in e) == [("DT", "CR1"), ("IP", "BR1"), ("OR", "AR1")]


def test_deactivation_removes_vertex_and_its_edges(spark):
    p = _parsed(spark, [SCHED, SCHED2, MSG_TS, DEACT])
    assert [r.rid for r in RL.current_vertices(p).collect()] == ["R2"]
    assert RL.current_edges(p).count() == 0
