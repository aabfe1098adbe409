"""The command line over a small landing folder: build twice, then ad-hoc SQL and DESCRIBE."""

from paddock.__main__ import main


def test_build_sql_describe(spark, scratch, tmp_path, capsys):
    land = tmp_path / "landing"
    land.mkdir()
    wh = scratch("cli")
    assert main(["build", "--landing", str(land), "--warehouse", wh]) == 1   # nothing has landed
    assert "raw_races" in capsys.readouterr().err
    (land / "raw_races.csv").write_text(
        "year,round,event_name,country,date\n"
        "3001,0,Rehearsal,Nowhere,3001-01-20\n"
        "3001,1,Island Grand Prix,Atlantis,3001-02-10\n"
        "3001,2,Cloud Grand Prix,Laputa,3001-02-24\n"
        "3001,3,Río Hondo Grand Prix,Utopia,3001-10-05\n", encoding="utf-8")
    assert main(["build", "--landing", str(land), "--warehouse", wh]) == 1   # the results have not
    (land / "raw_fastest_laps.csv").write_text(
        "year,round,event_name,driver_code,team,lap_time_seconds\n"
        "3001,1,Island Grand Prix,QUI,Windmill,95.25\n"
        "3001,2,Cloud Grand Prix,QUI,Windmill,90.125\n"
        "3001,3,Río Hondo Grand Prix,GUL,Brobdingnag,70.5\n", encoding="utf-8")
    (land / "raw_results.json").write_text(
        '{"year": 3001, "round": 1, "driver_number": "5", "driver_code": "QUI",'
        ' "full_name": "A. Quixote", "team": "Windmill", "position": 1.0, "points": 26.0, "status": "Finished"}\n'
        '{"year": 3001, "round": 1, "driver_number": "8",'
        ' "full_name": "L. Gulliver", "team": "Brobdingnag", "position": 19.0, "points": 0.0, "status": "Shipwreck"}\n'
        '{"year": 3001, "round": 2, "driver_number": "8", "driver_code": "GUL",'
        ' "full_name": "L. Gulliver", "team": "Brobdingnag", "position": 1.0, "points": 25.0,'
        ' "status": "Finished"}\n', encoding="utf-8")
    assert main(["build", "--landing", str(land), "--warehouse", wh]) == 0
    assert main(["build", "--landing", str(land), "--warehouse", wh]) == 0   # re-run: idempotent
    capsys.readouterr()
    assert main(["sql", "--warehouse", wh, "SELECT driver_code, wins, championship_position FROM driver_standings "
                 "WHERE wins > 0 ORDER BY championship_position"]) == 0
    out = capsys.readouterr().out.split("\n")
    assert out[1].split() == ["QUI", "1", "1"] and out[2].split() == ["GUL", "1", "2"]
    # a landed row without a code has the empty text; the rehearsal is no round
    assert main(["sql", "--warehouse", wh, "SELECT count(*) AS n FROM driver_standings WHERE driver_code = ''"]) == 0
    assert capsys.readouterr().out.split() == ["n", "1"]
    assert main(["sql", "--warehouse", wh, "DROP TABLE driver_standings"]) == 1
    assert main(["describe", "--warehouse", wh, "fastest_laps_enriched"]) == 0
    assert "lap_time_formatted (string)" in capsys.readouterr().out
    # a landed NaN lap time is a missing value: the not_null expectation fails the build
    (land / "raw_races.csv").write_text("year,round,event_name,country,date\n3002,1,Island Grand Prix,Atlantis,"
                                        "3002-03-05\n", encoding="utf-8")
    (land / "raw_fastest_laps.csv").write_text("year,round,event_name,driver_code,team,lap_time_seconds\n"
                                               "3002,1,Island Grand Prix,PAN,Windmill,NaN\n", encoding="utf-8")
    assert main(["build", "--landing", str(land), "--warehouse", wh]) == 1
    assert "not_null(fastest_laps_enriched.lap_time_seconds)=1" in capsys.readouterr().err
