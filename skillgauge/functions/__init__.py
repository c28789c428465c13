"""Column-returning helpers; all of them stay inside whole-stage codegen."""
