from simpairs.operators import history as hi


def _hist(spark, accs):
    rows = [(1, e, 1.0, a, 1.0 - a, a) for e, a in enumerate(accs)]
    return spark.createDataFrame(rows, "run long, epoch int, loss double, accuracy double, val_loss double, "
                                       "val_accuracy double")


def test_rules_differ_on_plateau(spark):
    h = _hist(spark, [0.9, 0.9004, 0.9, 0.9, 0.9])
    torch = hi.plateau_stop_torch(h).first()
    assert (torch.stop_epoch, torch.reason) == (4, "plateau")
    keras = hi.plateau_stop_keras(h).first()
    assert (keras.stop_epoch, keras.reason) == (3, "plateau")


def test_target_and_best_epoch(spark):
    h = _hist(spark, [0.5, 0.7, 0.996, 0.2])
    assert hi.plateau_stop_keras(h).first().reason == "target"
    b = hi.best_epoch(h).first()
    assert (b.best_acc_epoch, b.best_loss_epoch) == (2, 2)


def test_lr_schedule_halves_after_patience(spark):
    rows = [(1, e, 1.0, 0.5, 1.0, 0.5) for e in range(8)]
    h = spark.createDataFrame(rows, "run long, epoch int, loss double, accuracy double, val_loss double, val_accuracy double")
    lrs = [r.lr for r in hi.lr_schedule(h).orderBy("epoch").collect()]
    assert lrs == [0.001, 0.001, 0.001, 0.001, 0.0005, 0.0005, 0.0005, 0.00025]


def test_epoch_numbers_are_kept(spark):
    rows = [(1, e, 1.0, 0.5, 1.0, 0.5) for e in (0, 2, 4, 6)]
    h = spark.createDataFrame(rows, "run long, epoch int, loss double, accuracy double, val_loss double, val_accuracy double")
    assert [r.epoch for r in hi.lr_schedule(h).orderBy("epoch").collect()] == [0, 2, 4, 6]
    assert [r.epoch for r in hi.history_from_columnar(hi.history_columnar(h)).orderBy("epoch").collect()] == [0, 2, 4, 6]


def test_history_files_of_both_layouts(spark, tmp_path):
    import json

    from simpairs.sources.artifacts import load_history, save_history_csv, save_history_json
    (tmp_path / "cnn run+1.json").write_text(json.dumps({"loss": [2.0, 1.0], "accuracy": [0.1, 0.2], "val_loss": [3.0, 2.5]}, indent=2))
    got = load_history(spark, json_path=str(tmp_path / "cnn run+1.json")).orderBy("epoch").collect()
    assert [tuple(r) for r in got] == [("cnn run+1", 0, 2.0, 0.1, 3.0, None), ("cnn run+1", 1, 1.0, 0.2, 2.5, None)]
    (tmp_path / "lstm.csv").write_text("train_loss,train_accuracy,val_loss,val_accuracy\n2.0,0.1,3.0,0.3\n1.0,0.2,2.5,0.4\n")
    got = load_history(spark, csv_path=str(tmp_path / "lstm.csv")).orderBy("epoch").collect()
    assert [tuple(r) for r in got] == [("lstm", 0, 2.0, 0.1, 3.0, 0.3), ("lstm", 1, 1.0, 0.2, 2.5, 0.4)]
    (tmp_path / "bad.json").write_text("{not json")
    assert load_history(spark, json_path=str(tmp_path / "bad.json"), csv_path=str(tmp_path / "lstm.csv")) is None
    assert load_history(spark, json_path=str(tmp_path / "none.json"), csv_path=str(tmp_path / "lstm.csv")) is not None
    assert load_history(spark, json_path=str(tmp_path / "none.json")) is None
    h = spark.createDataFrame([(7, 0, 1.0, 0.5, 1.0, 0.5), (7, 3, 0.5, 0.6, 1.0, 0.5)],
                              "run long, epoch int, loss double, accuracy double, val_loss double, val_accuracy double")
    save_history_csv(h, str(tmp_path / "own.csv"))
    save_history_json(h, str(tmp_path / "own.json"))
    want = sorted(tuple(r) for r in h.collect())
    assert sorted(tuple(r) for r in load_history(spark, csv_path=str(tmp_path / "own.csv")).collect()) == want
    assert sorted(tuple(r) for r in load_history(spark, json_path=str(tmp_path / "own.json")).collect()) == want
