"""Training-data operators. Nothing else in gazetta imports this subpackage."""
