"""The test tables recast as sales relations, and the queries over them."""
