"""sievework: a candidate funnel, audit and corpus engine written for Spark."""
