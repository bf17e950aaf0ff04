"""Rules and settings, passed in explicitly by the caller.

The defaults are fixed values: cut points, thresholds, category names and the
feature order are what the results are defined by.
"""

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureRules:
    """Cut points of the gold features.

    Buckets are ``(name, exclusive upper bound)`` pairs in rising order; values at
    or above the last bound take the ``*_rest`` name. A null number also takes
    ``*_rest`` unless ``null_bucket`` names another value for it.
    """

    risky_late_payments: int = 3
    high_support_tickets: int = 7
    high_support_name: str = "is_high_support"
    tenure_cuts: tuple = (("new", 6), ("mid", 24))
    tenure_rest: str = "loyal"
    charge_cuts: tuple = (("low", 50), ("medium", 100))
    charge_rest: str = "high"
    null_bucket: str | None = None


# The looser support flag, kept under its own name.
ALT_SUPPORT_RULES = FeatureRules(
    high_support_tickets=5, high_support_name="is_high_support_customer"
)


@dataclass(frozen=True)
class LabelRules:
    """A customer counts as churned when any one of three patterns holds."""

    late_payments_from: int = 3
    tickets_with_late_payments_from: int = 7
    tenure_below: int = 6
    charges_above: int = 100
    fragile_plan: str = "Basic"
    tickets_on_fragile_plan_from: int = 5


@dataclass(frozen=True)
class InputRules:
    """Allowed values per column, and columns that must simply be present.

    No numeric ranges by default; ``ranges`` maps a column to ``(low, high)``,
    either end ``None`` for open.
    """

    domains: dict = field(
        default_factory=lambda: {
            "gender": ("Male", "Female"),
            "subscription_type": ("Basic", "Standard", "Premium"),
            "tenure_bucket": ("new", "mid", "loyal"),
            "charge_bucket": ("low", "medium", "high"),
        }
    )
    required: tuple = (
        "gender",
        "location",
        "subscription_type",
        "tenure_months",
        "monthly_charges",
        "support_tickets",
        "late_payments",
        "tenure_bucket",
        "charge_bucket",
    )
    ranges: dict = field(default_factory=dict)

    def without(self, *columns):
        """The same rules minus ``columns``, e.g. buckets that gold recomputes."""
        return InputRules(
            domains={c: v for c, v in self.domains.items() if c not in columns},
            required=tuple(c for c in self.required if c not in columns),
            ranges={c: v for c, v in self.ranges.items() if c not in columns},
        )


# Events that have not been through gold yet carry no trusted buckets.
EVENT_RULES = InputRules().without("tenure_bucket", "charge_bucket")


@dataclass(frozen=True)
class ModelSpec:
    """Inputs and solver settings of the churn classifier."""

    categorical: tuple = (
        "gender",
        "location",
        "subscription_type",
        "tenure_bucket",
        "charge_bucket",
    )
    numeric: tuple = (
        "monthly_charges",
        "tenure_months",
        "support_tickets",
        "late_payments",
    )
    label: str = "churn_label"
    weight: str = "class_weight"
    max_iter: int = 20
    threshold: float = 0.4
    train_percent: int = 80
    seed: int = 42
    # Places that all categories are hashed into; None keeps one place for each value.
    hash_width: int | None = None
    # Depth of the gradient aggregation tree; raise it with the executor count.
    aggregation_depth: int = 2

    @property
    def inputs(self):
        return self.categorical + self.numeric


@dataclass(frozen=True)
class Topics:
    """Names used when the hops run over Kafka."""

    raw_events: str = "churn_events"
    scoring_events: str = "churn_input"
    features: str = "churn_features"
    scores: str = "churn_output"
