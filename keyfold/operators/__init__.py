"""DataFrame -> DataFrame operators: flatten, collapse, merge/fold, history, layout, reconcile."""
