"""Road-network jobs: profile tables, way/node/turn/segment/relation rules, edges, paths."""
