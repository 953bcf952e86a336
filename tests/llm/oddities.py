"""Names that the operators use inside, for extra columns that clash with them."""

CLASHING = (
    "key size slice row part bytes tokens rows id at label of pass finish running range slot shard group "
    "fold own other pair block members copies words form _ start length taken target"
).split()
