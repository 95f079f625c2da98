"""thermocal: Spark-native sensor calibration and power regression.

Table-in / table-out operators over DataFrames: sources with column
checks, exact splits, feature expansion and scaling, least-squares fits,
distributed model training and scoring, error metrics, a two-model blend
and two room-temperature corrections.
"""

from thermocal.schema import FEATURES, TARGET  # noqa: F401

__version__ = "0.1.0"

_EXPORTS = {
    "get_spark": "thermocal.session",
    "read_readings": "thermocal.sources.readings", "array_to_columns": "thermocal.sources.readings",
    "rows_to_frame": "thermocal.sources.readings", "require_columns": "thermocal.sources.readings",
    "read_params": "thermocal.sources.params", "save_params": "thermocal.sources.params",
    "write_table": "thermocal.sources.sinks", "write_scored": "thermocal.sources.sinks",
    "write_poly_csv": "thermocal.sources.sinks", "write_split": "thermocal.sources.sinks",
    "sigmoid_weight": "thermocal.functions.expr", "ensemble_predict": "thermocal.functions.expr",
    "poly_powers": "thermocal.functions.poly", "poly_predict": "thermocal.functions.poly",
    "regression_metrics": "thermocal.operators.metrics", "evaluate": "thermocal.operators.metrics",
    "train_test_split": "thermocal.operators.split", "kfold": "thermocal.operators.split",
    "fit_scaler": "thermocal.operators.scaling", "standardize": "thermocal.operators.scaling",
    "fit_single": "thermocal.operators.linfit", "fit_multi": "thermocal.operators.linfit",
    "fit_adjuster": "thermocal.operators.adjust", "apply_adjuster": "thermocal.operators.adjust",
    "make_adjuster": "thermocal.operators.adjust", "adjust_values": "thermocal.operators.adjust",
    "blend_tables": "thermocal.operators.blend", "ensemble_inference": "thermocal.operators.blend",
    "fit_polynomial": "thermocal.operators.polyfit", "predict_polynomial": "thermocal.operators.polyfit",
    "train_random_forest": "thermocal.operators.trees", "train_boosted": "thermocal.operators.trees",
    "predict_model": "thermocal.operators.trees",
    "train_mlp": "thermocal.operators.mlp", "predict_mlp": "thermocal.operators.mlp",
}


def __getattr__(name):
    """Lazy re-exports, so ``import thermocal`` does not import PySpark ML."""
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
