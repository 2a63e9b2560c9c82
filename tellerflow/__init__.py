"""tellerflow: retail-banking customer analytics written as Spark jobs.

Layers: ``sources`` read feeds, ``operators`` keep history and resolve events,
``plans`` build the customer marts, serving tables and data-quality results,
``queries`` registers every operator by name next to its SQL oracle.
"""
