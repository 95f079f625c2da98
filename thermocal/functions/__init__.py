"""Column-expression building blocks (all JVM-side, whole-stage codegen)."""

from thermocal.functions.expr import (  # noqa: F401
    ensemble_predict, linear_eval, log10_checked, missing, pow10, present, sigmoid_weight,
)
from thermocal.functions.poly import (  # noqa: F401
    poly_feature_names, poly_powers, poly_predict, poly_terms,
)
