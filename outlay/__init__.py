"""outlay: capital-project spend analytics as Spark DataFrame plans.

Layers:
  sources/    readers for the landed inputs and the curated sinks
  functions/  pure Column expressions (search predicates, money, aging, ...)
  operators/  rollups, keyed precedence, merges, fund nodes, documents
  plans/      curated pipeline and the parameterised reports
  streaming/  micro-batch form of the document reconcile
"""
