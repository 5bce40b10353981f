"""Plan building blocks shared by the operators: order, groups, quantiles, lineage."""
