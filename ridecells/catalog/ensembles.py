"""Two small tree ensembles to score with."""

from ridecells.models.ensemble import Branches, Ensemble, Leaf


def _split(field, operator, other, value, first, second):
    return Branches([((field, operator, value), first), ((field, other, value), second)])


def _is_not(zip_code, if_not, if_so):
    return _split("zip", "notEqual", "equal", zip_code, if_not, if_so)


def _up_to(field, value, if_so, if_not):
    return _split(field, "lessOrEqual", "greaterThan", value, if_so, if_not)


# The zips that the two-tree ensemble declares.
ZIPS = (
    10119, 10003, 10012, 10014, 10020, 10010, 10022, 10016, 10023, 10024, 10028, 10065, 10021,
    10075, 10036, 10018, 10011, 10019, 10128, 11430, 10009, 10111, 10025, 10013, 11371, 10167,
    10173, 10165, 10154, 11369, 10001, 10017, 10007, 10174, 10278, 10002, 10168, 10112, 10004,
    11201, 10282, 10006, 10038, 11211, 10026, 11217, 10069, 10029, 10199, 10170, 10115, 10280,
    11106, 11101, 11222, 11104, 10044, 11103, 10035, 11231, 10103, 10037, 10027, 11109, 11215,
    11105, 11205, 11206, 11102, 10031, 10005, 10032, 10030, 10033, 11370, 11216, 11226, 11221,
    11225, 11213, 11377, 11237, 11232, 11372, 11218, 11374, 11373, 10040, 11238, 11420, 11436,
    10453, 11415, 10034, 11207, 10601, 7114, 7030, 7302, 11368, 6878, 11354, 11375, 7307, 7086,
    11385, 10462, 11413, 11378, 7011, 11212, 7087, 10039,
)

# Splits and scores of the two-tree ensemble over zip, weekday
# and hour.
ZIP_ENSEMBLE = Ensemble(
    trees=[
        _is_not(
            10014,
            _is_not(
                10016,
                _is_not(10119, Leaf(1.9247287522603977), Leaf(4.071895424836601)),
                Leaf(2.793388429752066)),
            _up_to(
                "weekday", 3.5,
                _up_to("hour", 22.5, Leaf(2.485294117647059), Leaf(4.0)),
                Leaf(3.253968253968254))),
        _is_not(
            10119,
            _up_to(
                "hour", 7.5,
                _is_not(10012, Leaf(1.55678391959799), Leaf(3.6363636363636362)),
                _is_not(10023, Leaf(2.103235294117647), Leaf(3.7373737373737375))),
            Leaf(3.9565217391304346)),
    ],
    categories={"zip": ZIPS},
)

# An exchange document of our own over the six features of the forest.
DEMAND_DOCUMENT = """<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3">
  <DataDictionary>
    <DataField name="hour" optype="continuous" dataType="integer"/>
    <DataField name="weekday" optype="continuous" dataType="integer"/>
    <DataField name="temperature" optype="continuous" dataType="integer"/>
    <DataField name="precipitation" optype="continuous" dataType="integer"/>
    <DataField name="cell_index_x" optype="continuous" dataType="integer"/>
    <DataField name="cell_index_y" optype="continuous" dataType="integer"/>
    <DataField name="count" optype="continuous" dataType="double"/>
  </DataDictionary>
  <MiningModel functionName="regression">
    <Segmentation multipleModelMethod="average">
      <Segment id="1"><True/><TreeModel functionName="regression">
        <Node><True/>
          <Node><SimplePredicate field="hour" operator="lessOrEqual" value="6.5"/>
            <Node score="1.25"><SimplePredicate field="cell_index_y" operator="lessOrEqual" value="180.5"/></Node>
            <Node score="0.5"><SimplePredicate field="cell_index_y" operator="greaterThan" value="180.5"/></Node>
          </Node>
          <Node><SimplePredicate field="hour" operator="greaterThan" value="6.5"/>
            <Node score="2.75"><SimplePredicate field="temperature" operator="lessOrEqual" value="1.5"/></Node>
            <Node><SimplePredicate field="temperature" operator="greaterThan" value="1.5"/>
              <Node score="4.5"><SimplePredicate field="precipitation" operator="lessOrEqual" value="0.5"/></Node>
              <Node score="3.25"><SimplePredicate field="precipitation" operator="greaterThan" value="0.5"/></Node>
            </Node>
          </Node>
        </Node>
      </TreeModel></Segment>
      <Segment id="2"><True/><TreeModel functionName="regression">
        <Node><True/>
          <Node><SimplePredicate field="cell_index_x" operator="lessOrEqual" value="110.5"/>
            <Node score="3.0"><SimplePredicate field="weekday" operator="lessOrEqual" value="5.5"/></Node>
            <Node score="5.5"><SimplePredicate field="weekday" operator="greaterThan" value="5.5"/></Node>
          </Node>
          <Node score="1.75"><SimplePredicate field="cell_index_x" operator="greaterThan" value="110.5"/></Node>
        </Node>
      </TreeModel></Segment>
      <Segment id="3"><True/><TreeModel functionName="regression">
        <Node><True/>
          <Node><SimplePredicate field="cell_index_y" operator="lessOrEqual" value="200.5"/>
            <Node score="2.0"><SimplePredicate field="hour" operator="lessOrEqual" value="18.5"/></Node>
            <Node score="6.25"><SimplePredicate field="hour" operator="greaterThan" value="18.5"/></Node>
          </Node>
          <Node><SimplePredicate field="cell_index_y" operator="greaterThan" value="200.5"/>
            <Node score="2.5"><SimplePredicate field="precipitation" operator="lessOrEqual" value="1.5"/></Node>
            <Node score="1.0"><SimplePredicate field="precipitation" operator="greaterThan" value="1.5"/></Node>
          </Node>
        </Node>
      </TreeModel></Segment>
    </Segmentation>
  </MiningModel>
</PMML>
"""
